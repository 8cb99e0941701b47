"""foreachBatch jobs on Structured Streaming."""
