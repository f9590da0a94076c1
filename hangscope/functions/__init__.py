"""Column-expression builders (built-in Spark SQL functions only)."""
