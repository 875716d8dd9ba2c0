"""Millrace: a layered shop warehouse (logs, change records, wide facts, statistics) on Spark.

Operators are functions from DataFrame to DataFrame. They hold no session, run no
action, and work on static and on streaming frames alike.
"""
