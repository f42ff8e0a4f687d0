"""Column expressions: text forms, guarded codes, property types."""
