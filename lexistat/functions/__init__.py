"""Column expressions: no joins, no shuffles, no Python code per row."""
