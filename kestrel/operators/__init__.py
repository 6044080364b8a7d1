"""DataFrame-to-DataFrame operators built from Spark's own relational operators."""
