"""Structured Streaming jobs and listeners."""
