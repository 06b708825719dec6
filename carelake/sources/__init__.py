"""Sources and sinks: CSV landing, driver-table fixtures, parquet sinks."""
