"""Sources (parquet tables, CSV, fixture adapters) and sinks."""
