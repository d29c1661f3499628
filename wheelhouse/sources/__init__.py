"""Readers: files, JDBC tables, generated rows, versioned tables."""
