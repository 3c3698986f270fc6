"""Terminology analytics on Spark."""
