"""Spark-native building blocks for curating, auditing and sampling text manifests."""

__version__ = "0.1.0"
