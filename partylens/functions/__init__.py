"""Column expressions: dates, numbers, text, nulls and vectors."""
