"""Readers for landed payloads, files and JDBC tables; every one has an explicit schema."""
