"""Sources and sinks: envelope tables, CSV lookups, Parquet round trips, and
the stand-in report inputs derived from the driver's tables."""
