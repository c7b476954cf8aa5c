"""Gridloom: a PySpark-native engine for irregularly sampled gridded observations."""

__version__ = "0.1.0"
