"""The stages as Structured Streaming queries."""
