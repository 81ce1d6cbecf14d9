"""Event-coincidence analytics on Spark."""
