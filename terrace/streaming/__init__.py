"""Incremental loading with Structured Streaming (foreachBatch over the batch operators)."""
