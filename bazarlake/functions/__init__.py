"""Column expressions: every function takes columns and returns a column."""
