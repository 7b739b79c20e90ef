"""Column functions: stamps, parsing and display text."""
