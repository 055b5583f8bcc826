"""Column-level rules (built-in Spark expressions) and the one vectorised UDF."""
