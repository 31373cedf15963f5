"""Sources and sinks: driver tables, landed raw tables, seeds, payloads, writers."""
