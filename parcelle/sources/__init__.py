"""Readers: the driver-table adapter, file scans, JDBC, JSON pages, GeoJSON."""
