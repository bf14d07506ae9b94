"""Column expressions: text cleaning, lenient parsing, keys, rounding."""
