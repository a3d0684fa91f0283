"""Structured Streaming forms of the loads."""

from skylattice.streaming.loads import stream_current, stream_forecast

__all__ = ["stream_current", "stream_forecast"]
