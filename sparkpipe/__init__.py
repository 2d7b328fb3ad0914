"""Lakehouse pipeline operators as lazy Spark DataFrame functions."""
