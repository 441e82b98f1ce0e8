"""Structured Streaming: sources, runs, windows, joins, state and sinks."""
