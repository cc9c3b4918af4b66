"""Sources and sinks: driver tables, fixtures, CSV, stage and parameter tables."""
