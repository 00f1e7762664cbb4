"""The same analyses as Structured Streaming queries."""
