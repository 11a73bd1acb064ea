"""Structured Streaming: the micro-batch job and stream-only operators."""
