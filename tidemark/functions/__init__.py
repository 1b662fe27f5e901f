"""Column expressions: log positions, types, time."""
