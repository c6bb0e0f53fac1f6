"""Operators for training-data pipelines: dedup, decontamination, extraction, labelling and mixing."""
