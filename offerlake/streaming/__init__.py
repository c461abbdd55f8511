"""Structured Streaming: the raw zone receives dated file drops; a file-source stream lands each new drop once."""

from offerlake.streaming.landing import land_drops

__all__ = ["land_drops"]
