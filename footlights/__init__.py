"""Listings integration on Spark: functions from DataFrames to DataFrames."""
