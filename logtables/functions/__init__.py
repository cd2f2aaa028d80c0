"""Column functions: all run inside Catalyst expressions."""
