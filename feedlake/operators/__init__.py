"""Operators over DataFrames: parsing, rules, versions, upsert, routing, checks."""
