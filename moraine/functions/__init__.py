"""Column expressions: names, dates, time zones."""
