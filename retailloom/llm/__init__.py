"""Operators of a training-data pipeline over text documents; nothing else in the package imports them."""
