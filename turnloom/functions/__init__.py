"""Column expressions used throughout."""
