"""Marketplace analytics as DataFrame operators on Spark."""
