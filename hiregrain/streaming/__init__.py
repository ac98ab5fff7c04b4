"""Structured Streaming jobs: worker, failure archive, replay and trends."""
