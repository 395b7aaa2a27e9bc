"""Column expressions: no actions, no UDFs."""
