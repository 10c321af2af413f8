"""Sources and sinks: raw CSV drops, tables, the driver test tables."""
