"""Operators of a training-data pipeline, each by the method it names."""
