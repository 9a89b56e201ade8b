"""Column-level helpers: nulls, casts, JSON records, calendar parts."""
