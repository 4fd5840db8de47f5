"""gleanery: a PySpark-native engine for curating image and document corpora."""

__version__ = "0.1.0"
