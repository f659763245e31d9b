"""Star-schema analytics for subscription businesses, written for Spark."""
