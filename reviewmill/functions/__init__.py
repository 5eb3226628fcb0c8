"""Column expressions: text masks and cleaning, tokens, labels, numbers."""
