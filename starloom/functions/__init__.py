"""Column functions; everything here stays inside Spark's generated code."""
