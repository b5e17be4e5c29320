"""Schemas, landing scans and sinks, and the test-table mapping."""
