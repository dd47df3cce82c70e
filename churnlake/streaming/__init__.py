"""Structured Streaming jobs (K1-K6).  Each alert is one function used by
both the batch and the streaming plan."""
