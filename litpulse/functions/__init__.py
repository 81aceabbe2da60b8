"""Column expressions: text, dates, identifiers, JSON."""
