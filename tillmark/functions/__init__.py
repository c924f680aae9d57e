"""Column expressions: dates, exact money arithmetic, hash-seeded draws, text."""
