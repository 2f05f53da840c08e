"""Column expressions: null handling, text cleaning, dates and name rules."""
