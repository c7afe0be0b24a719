"""File ingest, lookup tables, table readers and writers."""
