"""Operators of a training-data pipeline over text, conversations and vectors."""
