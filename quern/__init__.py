"""Corpus processing on Spark: scan, clean, split, score, convert and shard document collections."""
