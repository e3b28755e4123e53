"""JSON, row-array, XML and parquet sinks."""
