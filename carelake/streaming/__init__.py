"""Structured Streaming: envelopes, windowed aggregates, sinks."""
