"""Structured Streaming forms of the event builder."""
