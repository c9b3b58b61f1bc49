"""Sources and sinks: the only modules that touch storage."""

from stayframe.sources.tables import read_table, read_csv, land_measurements
from stayframe.sources.events import (
    EVENT_SCHEMA,
    read_events,
    parse_events,
    stamp_ingestion,
    to_event_json,
)
from stayframe.sources.sinks import write_table, verify_written, write_report_csv

__all__ = [
    "read_table",
    "read_csv",
    "land_measurements",
    "EVENT_SCHEMA",
    "read_events",
    "parse_events",
    "stamp_ingestion",
    "to_event_json",
    "write_table",
    "verify_written",
    "write_report_csv",
]
