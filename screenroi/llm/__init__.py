"""Training-data operators (quality, dedup, privacy, mixing, tokens, packing) on Spark.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` chains five of its operators.
"""
