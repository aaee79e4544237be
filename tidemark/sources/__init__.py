"""Readers and writers: table role mappings, JSON message decoding, CSV / JSON
files, JDBC, keyed message sinks, the result envelope and in-memory inputs."""
