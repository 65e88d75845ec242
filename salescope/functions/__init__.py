"""Column expressions: no data access, no UDFs."""
