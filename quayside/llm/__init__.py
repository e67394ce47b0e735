"""Operators of training-data pipelines: cleaning, language, near copies, tokens, quality, packing."""
