"""Incremental ingestion of monthly CSV drops with Structured Streaming."""
