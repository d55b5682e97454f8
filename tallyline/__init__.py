"""Spark-native cloud cost analytics and asset governance.

Every operator takes DataFrames and returns DataFrames.  Nothing here collects
rows to the driver; reference times are always arguments.
"""
