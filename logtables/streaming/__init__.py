"""Structured Streaming form of the log export."""
