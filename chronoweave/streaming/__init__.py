"""Structured Streaming: keep appending newly arriving tag files to a stored dataset."""

from chronoweave.streaming.append import start_append_stream

__all__ = ["start_append_stream"]
