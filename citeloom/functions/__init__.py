"""Column-level building blocks: scalars, nested values and predicates."""
