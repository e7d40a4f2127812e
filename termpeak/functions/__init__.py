"""Column expressions: text in, words or checked fields out."""
