"""Column expressions: text, vectors, contact fields."""
