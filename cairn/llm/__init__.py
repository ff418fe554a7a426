"""Operators of a training-data pipeline: mixing, sharding, near-duplicates, quality, language, PII, chat, packing."""
