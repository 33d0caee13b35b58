"""Sources and sinks: message folders, JSON topics, Parquet datasets."""
