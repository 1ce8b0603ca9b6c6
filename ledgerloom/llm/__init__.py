"""Operators for training-data pipelines: cleaning, matching, packing and archiving of text."""
