"""Flows composed from operators."""
