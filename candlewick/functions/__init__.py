"""Column functions: plain expressions over Spark's built-in functions."""
