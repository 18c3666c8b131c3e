"""Incremental (streaming) trigger of the load job."""
from .snapshots import snapshot_stream, start_incremental_load  # noqa: F401
