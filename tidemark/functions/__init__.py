"""Column-level helpers: names, cleaning rules, type mapping, literals."""
