"""Structured Streaming: live availability ingestion and critical-station alerts."""
