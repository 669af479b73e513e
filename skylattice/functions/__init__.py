"""Column functions: geometry, text, formats."""
