"""Readers: files, event streams, catalog and JDBC tables."""
