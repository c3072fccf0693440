"""Retail analytics as composable Spark DataFrame operators.

Layers: ``sources`` (typed loads and writes) -> ``operators`` (staging, star
schema, history, quality, monitoring) -> ``plans`` (assembled tables and
serving queries); ``streaming`` runs the same operators on unbounded input.
Every operator takes DataFrames and returns a DataFrame; actions happen only in
writers, quality gates and stream starts.
"""
