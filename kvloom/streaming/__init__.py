"""The live phase as a Structured Streaming query."""
