"""statloom: a PySpark-native engine for statistical-reporting analytics over article corpora."""

__version__ = "0.1.0"
