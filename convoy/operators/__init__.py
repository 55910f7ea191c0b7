"""Operators: functions from DataFrames to a DataFrame. Nothing here runs a job or fetches rows."""
