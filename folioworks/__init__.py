"""Spark jobs for the data side of digitised-archive retrieval.

URL lists, landed catalogue responses, landed HTML and download logs come in as tables; every job maps
DataFrames to DataFrames and leaves the physical strategy to Catalyst and adaptive execution.
"""
