"""Operators for training-data pipelines: ten DataFrame operators, their queries and their SQL."""
