"""Column-level building blocks. All of them stay inside Spark expressions."""
