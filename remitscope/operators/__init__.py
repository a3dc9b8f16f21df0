"""Operators: functions from DataFrame to DataFrame, the same in batch and on a stream."""
