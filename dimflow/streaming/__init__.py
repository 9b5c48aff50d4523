"""Micro-batch loading of arriving batch folders."""

from dimflow.streaming.batch_loader import stream_load

__all__ = ["stream_load"]
