from fareloom.sources.events import EVENT_SCHEMA, parse_events, read_events
from fareloom.sources.tables import load_table, save_table

__all__ = ["EVENT_SCHEMA", "load_table", "parse_events", "read_events", "save_table"]
