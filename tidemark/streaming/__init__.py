from tidemark.streaming.stateful import newest_in_state, upsert_in_state
from tidemark.streaming.upserts import run_available, stream_landing, upsert_stream

__all__ = ["newest_in_state", "run_available", "stream_landing", "upsert_in_state", "upsert_stream"]
