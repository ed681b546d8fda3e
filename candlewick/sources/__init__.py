"""Sources and sinks: tables, vendor payloads, files, message topics and versioned snapshots."""
