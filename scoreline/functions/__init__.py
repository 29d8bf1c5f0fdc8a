"""Column expressions: text, numbers and keyed pseudo-randomness."""
