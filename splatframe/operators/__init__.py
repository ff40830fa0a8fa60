"""Operators on clouds: validation, selection, aggregation, lookups, comparison and import options."""
