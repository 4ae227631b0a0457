"""Files, broker records, catalog tables and integrity checks."""
