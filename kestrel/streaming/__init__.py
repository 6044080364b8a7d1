"""Structured Streaming: running the log queries over replayable file
streams with checkpointed state and idempotent, batch-tagged sinks."""
