"""Opinion and topic mining over document tables, written as Spark DataFrame operators."""

__version__ = "0.1.0"
