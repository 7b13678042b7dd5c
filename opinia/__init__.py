"""Labelled-text analytics as plain Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame``. See README.md for the map.
"""
