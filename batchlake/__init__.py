"""Spark-native toolkit for industrial batch-process sensor logs."""
