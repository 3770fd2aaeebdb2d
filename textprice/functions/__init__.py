"""Column expressions: text cleaning, tokenising, word extraction, labels, hashing."""
