"""DataFrame operators: dedup, joins, keys, ordering, checks."""
