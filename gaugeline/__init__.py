"""Sensor analytics as DataFrame, SQL and Structured Streaming operators."""
