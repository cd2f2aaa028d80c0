"""Request-log and entity-snapshot tables on Spark."""
