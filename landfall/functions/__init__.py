"""Column expressions and fixed code lists."""
