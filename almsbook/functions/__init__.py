"""Column expressions: calendar, text and money."""
