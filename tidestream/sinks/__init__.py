"""Writers of tables and files. Batches and days replace themselves; JDBC and baselines append."""
