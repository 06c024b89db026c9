"""Readers and writers for raw files, snapshot tables, records and metrics."""
