"""Operators of a training-data pipeline: cleaning, duplicates, tokens, shards, packing, search."""
