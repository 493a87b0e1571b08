"""Incremental pick-up of report exports with Structured Streaming."""
