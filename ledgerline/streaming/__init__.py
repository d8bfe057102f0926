"""Structured Streaming jobs and their batch-keyed outputs."""
