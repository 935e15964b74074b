"""Column expressions: cleaning, periods and metrics."""
