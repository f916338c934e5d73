"""Operators of a training-data pipeline: tokens, packing, language, quality, copies, leaks and lines."""
