"""The refresh as Structured Streaming queries, which read each landed file once."""
from snapstats.streaming.incremental import stream_records, stream_win_rate

__all__ = ["stream_records", "stream_win_rate"]
