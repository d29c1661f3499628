"""Structured Streaming: sources, parsing, event-time windows and sinks."""
