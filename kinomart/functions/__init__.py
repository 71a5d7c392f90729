"""Column expressions and the set-based form of the database functions."""
