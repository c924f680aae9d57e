"""Retail transaction analytics as DataFrame operators on Spark SQL built-ins."""
