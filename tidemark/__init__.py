"""tidemark: a PySpark-native engine for commit-ordered change data."""
