"""Readers and writers: objects, JSONL, artifacts, keyed tables, indexes."""
