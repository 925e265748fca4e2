"""Column expressions: text, sprint versions, dates and non-failing casts."""
