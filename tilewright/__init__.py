"""Spark-native sequence selection and large-scale data preparation."""

__version__ = "0.1.0"
