"""Column expressions: names, documents, configuration keys."""
