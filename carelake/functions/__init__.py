"""Column expressions: rounding, privacy and clinical rules."""
