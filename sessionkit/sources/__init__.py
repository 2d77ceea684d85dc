"""Declared schemas, the driver-table adapter, scans and sinks."""
