"""Column functions and broadcast statistics."""
