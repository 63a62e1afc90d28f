"""The same operators run incrementally with Structured Streaming."""
