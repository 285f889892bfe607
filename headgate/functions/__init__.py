"""Column expressions: values, type names, checkpoint tokens."""
