"""Column expressions and schema plans."""
