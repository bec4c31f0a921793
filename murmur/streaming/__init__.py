"""Structured Streaming: ingest, jobs and sinks."""
