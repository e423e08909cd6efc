"""Sources (table readers, test-data adapters) and sinks."""
