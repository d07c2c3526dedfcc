"""Operators for training-data pipelines: chat texts, joins, token files, models, mixing."""
