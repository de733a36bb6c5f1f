"""Structured Streaming: continuous landing and per-batch merges."""
