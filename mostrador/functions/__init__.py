"""Column expressions: text, numbers, labels, word rules. No Python runs per row."""
