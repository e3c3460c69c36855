"""Event-time sensor statistics on Spark, in batch and in Structured Streaming."""
