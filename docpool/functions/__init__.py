"""Column expressions and plain functions that the operators share."""
