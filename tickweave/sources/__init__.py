"""Readers: driver tables, derived market fixtures, staged listings/pages, JDBC."""
