"""Market-tick analytics on Spark: one set of transforms for batch tables and streams."""
