"""lakespan: a PySpark-native table bridge and corpus toolkit."""
