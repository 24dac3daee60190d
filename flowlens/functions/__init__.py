"""Column expressions: features, rule scores, repeatable hashing. All run inside codegen."""
