"""basketry — Spark-native real-time and historical shop analytics.

Every metric is one DataFrame function built from native Spark
expressions; the same function serves batch DataFrames and Structured
Streaming DataFrames wherever Spark allows it.
"""

__version__ = "0.1.0"
