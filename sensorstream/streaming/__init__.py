"""Structured Streaming: watermarks, windows, sinks, query runner."""
