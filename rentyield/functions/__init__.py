"""Column expressions: text standardisation, predicates and casts."""
