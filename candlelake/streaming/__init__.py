"""Structured Streaming: the scheduled incremental run as a stream over the landing folder (T1), and the
lookback for late and replayed days (T2), as a watermark or as state that sets late days aside."""

from .incremental_stream import start_incremental_stream
from .late_dedup import start_late_dedup_stream
from .late_rows import start_late_rows_stream

__all__ = ["start_incremental_stream", "start_late_dedup_stream", "start_late_rows_stream"]
