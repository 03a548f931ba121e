"""Column expressions: names, times and texts, all from built-in functions."""
