"""Column expressions: text, dates, amounts, and validation rules."""
