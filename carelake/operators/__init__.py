"""Relational operators of the pipeline: cleaning, dedup, upsert, integrity."""
