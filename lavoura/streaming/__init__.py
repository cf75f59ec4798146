"""Structured Streaming jobs: ingest, incremental refresh and continuous scoring."""
