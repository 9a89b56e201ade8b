"""Table-level operators: projection, distinct, merge, keys, constraints, layout."""
