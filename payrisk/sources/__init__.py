"""Sources and sinks: table scans, tolerant log scans, CSV, JSON streams."""
