"""Column expressions and word lists."""
