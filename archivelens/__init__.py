"""archivelens: a PySpark-native analytics engine for document archives."""
