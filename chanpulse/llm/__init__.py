"""Operators of a training-data pipeline: search, tokens, language, archives,
quality, toxicity, fingerprints, shards, mixes and near copies.

Nothing else in the library imports this subpackage.
"""
