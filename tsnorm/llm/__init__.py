"""Operators of a training-data pipeline over text, vectors, conversations and pages."""
