"""Operators of a training-data pipeline over documents. Nothing outside this folder imports it."""
