"""Column expressions, formula handling and distribution functions."""
