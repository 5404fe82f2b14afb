"""Structured Streaming drivers for the loads (the reference itself runs daily batches only)."""

from lakeload.streaming.gold_stream import gold_stream

__all__ = ["gold_stream"]
