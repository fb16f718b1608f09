"""Column and projection helpers: geometry, seeded draws, text."""
