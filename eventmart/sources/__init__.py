"""Event files, the raw table, lookups, and table sinks."""
