"""Operators of a training-data pipeline: filtering, deduplication, tokens, archives, shards."""
