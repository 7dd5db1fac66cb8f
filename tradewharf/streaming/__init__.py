"""Structured Streaming jobs: landing of arriving files and the keyed upsert behind it."""

from tradewharf.streaming.landing import stream_land, stream_upsert

__all__ = ["stream_land", "stream_upsert"]
