"""Column expressions: text, scoring, rounding, display."""
