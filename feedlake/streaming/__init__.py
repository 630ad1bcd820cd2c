"""Load-once ingestion with file-source streams."""
