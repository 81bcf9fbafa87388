"""Visibility preprocessing on Spark."""
