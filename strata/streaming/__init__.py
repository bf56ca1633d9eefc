"""Structured Streaming: incremental landing-zone ingestion."""
