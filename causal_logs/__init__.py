"""Vector-clock log analytics on Spark."""
