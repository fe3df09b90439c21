"""Column expressions, column names and the page parsing helper."""
