"""snaplake: daily-snapshot movie catalogue analytics on Spark.

Layers: landing JSON -> lake (Parquet by day) -> raw (insert-if-absent) -> silver
"""

__version__ = "0.1.0"
