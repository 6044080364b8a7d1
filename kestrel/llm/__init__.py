"""Training-data operators: search, language identification, deduplication,
mixing, tokenised output, licence scans, packing and quality rules.

Nothing outside this package imports it. ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
