"""Structured Streaming: landing, replay safety, live metrics and enrichment."""
