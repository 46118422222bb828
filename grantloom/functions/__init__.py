"""Column expressions: text, money, dates and the row fingerprint."""
