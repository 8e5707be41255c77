"""Sources and sinks: dated snapshots, layered catalog, parameter tables, calendar."""
