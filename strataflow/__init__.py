"""Layered (raw → cleansed → aggregated) analytics as plain PySpark DataFrame code."""
