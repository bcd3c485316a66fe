"""Sources and sinks: driver tables, fixture views, files, model store."""
