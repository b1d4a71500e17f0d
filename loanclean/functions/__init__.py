"""Column expressions shared by the table operators."""
