"""fleetlens: trip analytics and Spark run-metrics analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
