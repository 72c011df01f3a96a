"""tessera — Spark-native quality analytics and model-operations marts."""

__version__ = "0.1.0"
