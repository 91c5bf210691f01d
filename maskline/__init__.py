"""maskline: a PySpark-native engine for finding, transforming and accounting for sensitive values."""
