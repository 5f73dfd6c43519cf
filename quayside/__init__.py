"""Tenant-aware message protection and landing, as composable Spark DataFrame functions."""

__version__ = "0.1.0"
