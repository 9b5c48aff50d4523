"""Readers: tables, JDBC, delimited dumps, ORC batches, schema documents."""
