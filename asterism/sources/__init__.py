"""Where tables come from and go to: JSON trees, Parquet tables, staged tables."""
