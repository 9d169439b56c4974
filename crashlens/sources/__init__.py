from crashlens.sources.pings import RAW_COLUMNS, read_raw_pings, select_ping_columns
from crashlens.sources.fixtures import events_as_main_summary, fixture_pings

__all__ = ["RAW_COLUMNS", "read_raw_pings", "select_ping_columns", "events_as_main_summary", "fixture_pings"]
