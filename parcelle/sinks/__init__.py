"""Writers: files (any format, dated, nested-safe CSV, GeoJSON) and JDBC."""
