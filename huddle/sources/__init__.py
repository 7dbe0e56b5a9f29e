"""Readers: CSV files, JDBC tables and catalog/path tables."""
