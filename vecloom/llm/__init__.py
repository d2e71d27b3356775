"""Operators of a training-data pipeline: filtering, deduplication, mixing, ordering and packing of documents."""
