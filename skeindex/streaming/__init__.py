"""Scheduled incremental runs on Structured Streaming."""
