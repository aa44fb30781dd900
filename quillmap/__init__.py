"""quillmap: a PySpark-native engine for text canonicalization and data preparation."""
