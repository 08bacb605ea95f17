"""DataFrame-level helpers: filter, project, distinct, lookup join, layout."""
