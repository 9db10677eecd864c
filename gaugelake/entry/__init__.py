"""The queries that run over the star-schema tables, and the same results as SQL."""
