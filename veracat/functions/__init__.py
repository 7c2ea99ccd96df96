"""Column expressions. Nothing here is a UDF: every function returns a built-in Spark expression."""
