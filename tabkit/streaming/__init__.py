"""Structured Streaming: landing-zone ingestion with quarantine."""
