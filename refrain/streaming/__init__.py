"""Structured streaming."""

from refrain.streaming.batches import prepare_stream, read_batches
from refrain.streaming.items import stream_raw_csv, write_prepared_stream

__all__ = ["prepare_stream", "read_batches", "stream_raw_csv", "write_prepared_stream"]
