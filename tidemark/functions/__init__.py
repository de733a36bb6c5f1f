"""Column-level helpers: NULL defaults, period predicates, names, tokens."""
