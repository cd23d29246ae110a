"""Column functions. All are built from Spark's own expressions."""
