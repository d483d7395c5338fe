"""PySpark-native analytics over gridded, multi-model climate tables."""
