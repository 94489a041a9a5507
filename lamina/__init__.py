"""Layered (raw -> bronze -> silver -> gold) trip analytics on the Spark DataFrame API."""
