"""Event-log analytics for ride data, built from Spark DataFrame operators."""
