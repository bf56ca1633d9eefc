"""Sources and sinks: CSV landing files, exports, profile JSON, catalog, JDBC."""
