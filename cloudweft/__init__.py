"""PySpark-native engine for point-cloud scan packages and the job messages that drive them."""

__version__ = "0.1.0"
