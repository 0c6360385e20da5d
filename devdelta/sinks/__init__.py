"""Sinks: record layouts (Kafka key/value), Kafka, JDBC, files, console, and
the main/late split written from one pass."""
