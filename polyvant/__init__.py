"""Spark-first evaluation of how varied a delivery of recorded episodes is."""
