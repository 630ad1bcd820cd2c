"""Column functions: dates, pipe-delimited text, JSON documents."""
