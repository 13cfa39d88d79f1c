"""Column expressions: row-wise arithmetic, dates and display text."""
