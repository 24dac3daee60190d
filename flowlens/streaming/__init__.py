"""Structured Streaming: decode, score, deliver."""
