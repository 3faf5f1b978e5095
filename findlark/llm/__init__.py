"""Operators of a training-data pipeline on Spark; nothing outside this folder imports it."""
