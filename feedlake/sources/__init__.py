"""Landing of text and JSON files, scratch tables and versioned table storage."""
