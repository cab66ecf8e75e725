"""Sources and sinks: message publishing, tables, run-result files."""
