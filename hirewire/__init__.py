"""Spark-native job-posting pipeline: landed career-board payloads to a deduplicated jobs table."""

__version__ = "0.1.0"
