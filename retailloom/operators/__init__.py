"""DataFrame-to-DataFrame operators: staging, star schema, history, quality, monitoring."""
