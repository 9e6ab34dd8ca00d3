"""Operators: functions from DataFrames (plus parameters) to DataFrames."""
