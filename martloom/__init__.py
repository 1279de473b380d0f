"""Spark-native operators and marts for a warehouse or lake.

Every operator is a function from DataFrames to a DataFrame. Clock values, time zones,
status codes and bucket counts are parameters; nothing reads the wall clock on its own.
"""
