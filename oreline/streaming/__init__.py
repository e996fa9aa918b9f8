"""Structured Streaming jobs: trip events and landing files."""
