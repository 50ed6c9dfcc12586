"""Snapshot-based job-posting analytics on Spark DataFrames."""
