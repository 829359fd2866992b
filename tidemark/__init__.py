"""tidemark: from nested JSON landing data to point-in-time features, on Spark.

Layers: ``sources`` read, ``functions`` are column helpers, ``operators`` map
DataFrames to DataFrames, ``sinks`` and ``streaming`` write, ``plans`` hold the
declarative table and feature specs and compose the rest.
"""
