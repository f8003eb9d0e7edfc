"""Incremental ingestion of raw event files into the staged table.

The measurement itself is a batch rebuild (first exposures and window
attribution need all events of a user); only staging is incremental.
"""

from liftlens.streaming.ingest import stage_event_stream, write_staged_stream

__all__ = ["stage_event_stream", "write_staged_stream"]
