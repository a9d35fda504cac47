"""Text search and term analytics as plain Spark DataFrames."""
