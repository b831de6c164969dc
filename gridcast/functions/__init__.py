"""Column expressions: dates, scores and blends."""
