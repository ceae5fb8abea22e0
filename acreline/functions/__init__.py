"""Column expressions: class codes, keys, ids, measures, projections."""
