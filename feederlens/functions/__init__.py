"""Column expressions. Everything here is a Catalyst expression, never a UDF."""
