"""Column functions. All are built from Spark expressions, so plans stay inside generated code."""
