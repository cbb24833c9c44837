"""A PySpark-native analytics engine for semi-structured entity data."""
