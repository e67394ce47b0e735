"""Incremental pick-up of files with Structured Streaming."""
