"""Assembled work: the star schema, its declared checks and the serving queries."""
