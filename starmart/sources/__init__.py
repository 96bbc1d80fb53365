"""Sources and sinks: delimited-file ingest, parquet/table scans, the derived fixture, writers."""
