"""Whole runs: the daily batch, the derived feeds and the registered queries."""
