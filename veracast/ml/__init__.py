"""Spark ML training and scoring."""
