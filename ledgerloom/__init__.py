"""Governed contracting-data analytics expressed as Spark DataFrame plans."""
