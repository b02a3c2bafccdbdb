"""Column expressions shared by all operators."""
