"""A PySpark lakehouse for advertising click and conversion events."""
