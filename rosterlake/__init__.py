"""Spark-native ETL operators and pipelines for file-delivered workforce data."""
