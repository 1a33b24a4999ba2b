"""Spark-native building blocks for a deduplicated article corpus.

Feeds and pages that were landed as tables become one article table. Every
operator is a function from DataFrames to a DataFrame; nothing runs until an
action is called, and the same functions serve batch and streaming jobs.
"""
