"""Spark-native analytics over live, located event feeds.

Sub-packages
------------
functions   Column expressions: casts, text rules, grid cells, bands, code tables.
sources     Feed and reference-file readers that return typed DataFrames.
operators   DataFrame to DataFrame building blocks shared by batch and streaming.
plans       Layered tables (staging, intermediate, marts) and serving queries.
streaming   Windowed jobs, idempotent keyed sinks and runners.
"""
