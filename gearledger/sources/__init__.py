"""Readers and writers: parquet tables, JDBC tables and the domain views."""
