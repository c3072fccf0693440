"""Typed reads and writes: NDJSON, keyed topics, raw tables and the load audit."""
