"""Territorial analytics on Spark: plain ``DataFrame -> DataFrame`` functions."""
