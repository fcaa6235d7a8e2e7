"""corpusmill: a PySpark-native engine for building annotated text datasets."""

__version__ = "0.1.0"
