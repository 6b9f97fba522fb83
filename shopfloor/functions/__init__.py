"""Column expressions with PostgreSQL semantics."""
