"""Operators for training-data pipelines: text quality, duplicates, secrets, languages and tokens."""
