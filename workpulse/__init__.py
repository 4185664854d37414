"""workpulse: Spark-native operators for workforce and punch-clock analytics."""

__version__ = "0.1.0"
