"""Whole plans: from raw rows to decoded clouds, and the registered queries."""
