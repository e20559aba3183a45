"""Structured Streaming around the near-real-time run."""

from docloom.streaming.feed import (
    file_changes,
    kafka_changes,
    message_changes,
    run_change_stream,
)

__all__ = ["file_changes", "kafka_changes", "message_changes", "run_change_stream"]
