"""Batch and streaming quality engine and mart builder for taxi trips, on Spark DataFrames."""
