"""Operators of a training-data pipeline: quality, tokens, duplicates, neighbours, mixing, secrets, URLs, archives."""
