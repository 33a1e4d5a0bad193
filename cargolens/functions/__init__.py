"""Column expressions: text, parsing, numbers and dates."""
