"""Column-level helpers: calendar parts and surrogate keys."""
