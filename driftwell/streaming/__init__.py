"""Scoring and drift watching on Structured Streaming."""
