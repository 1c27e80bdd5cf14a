"""Column functions: every one builds a native Spark expression."""
