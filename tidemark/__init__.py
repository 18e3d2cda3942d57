"""Ingestion and analysis of application logs and profile-update messages on Spark."""

__version__ = "0.1.0"
