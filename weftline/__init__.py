"""A PySpark-native engine for bilingual record integration (see README)."""
