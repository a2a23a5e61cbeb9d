"""Sources and sinks: driver tables, star-schema adapters, raw listings, writers."""
