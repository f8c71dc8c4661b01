"""DataFrame-level building blocks: keys, joins, grouping and ranking."""
