"""Gridded-climate analytics as plain functions over Spark DataFrames."""
