"""Sources (NDJSON events, driver tables, stored tables) and sinks."""

from liftlens.sources.events import (
    canonical_events,
    driver_events,
    read_ndjson_events,
    events_as_text,
)
from liftlens.sources.tables import (
    WAREHOUSE_TABLES,
    read_table,
    write_csv,
    write_table,
)

__all__ = [
    "canonical_events", "driver_events", "read_ndjson_events", "events_as_text",
    "WAREHOUSE_TABLES", "read_table", "write_table", "write_csv",
]
