"""Sources, sinks and versioned tables."""
