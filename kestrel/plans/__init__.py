"""The reference's named queries, each a function of (spark, sf_dir)."""
