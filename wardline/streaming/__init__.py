"""Structured Streaming entry points: change capture, realtime mart, raw ingest."""
