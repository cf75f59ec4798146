"""Column expressions: everything here stays inside Spark's generated code."""
