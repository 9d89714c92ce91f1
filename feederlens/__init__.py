"""Operational power-grid analytics as Spark DataFrame operators."""
