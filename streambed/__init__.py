"""Streambed: change-data-capture lakehouse operators on PySpark."""
