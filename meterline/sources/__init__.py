"""Sources (driver tables, JSON payloads, seeds, calendar) and sinks."""
