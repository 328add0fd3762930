"""Column-level building blocks; every one is a native Spark expression."""
