"""Structured Streaming: messages to Bronze tables, and first-seen filtering of a stream."""
