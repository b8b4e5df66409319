"""Operators for building training data sets, as DataFrame jobs."""
