"""Sources (the eight operational tables, the driver-data mapping) and the CSV sink."""
