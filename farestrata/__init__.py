"""Layered trip analytics on Spark: raw -> bronze -> silver -> gold."""
