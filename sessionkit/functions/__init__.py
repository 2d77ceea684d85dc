"""Column expressions and exact distributed quantiles."""
