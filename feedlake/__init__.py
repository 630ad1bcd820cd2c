"""Feed-to-curated processing as DataFrame operators on Spark."""
