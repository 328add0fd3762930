"""Content-recommendation analytics as PySpark DataFrame jobs.

Sub-packages
------------
functions   column expressions (text, vectors, scoring, keys)
sources     tables, streams and the adapters from the test data
operators   DataFrame -> DataFrame data products
streaming   Structured Streaming twins of the online products
plans       whole jobs, the query catalogue and its SQL oracles
"""
