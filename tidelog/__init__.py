"""Partitioned-log archive operators for PySpark."""
