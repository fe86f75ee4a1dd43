"""Incremental processing of logs and frames with Structured Streaming."""
