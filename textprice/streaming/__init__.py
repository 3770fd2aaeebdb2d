"""Structured Streaming: message ingest, continuous scoring, post/prediction correlation,
live totals, de-duplication and dead-letter handling."""
