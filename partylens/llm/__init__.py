"""Operators for training-data pipelines; the queries over them are in ``queries``."""
