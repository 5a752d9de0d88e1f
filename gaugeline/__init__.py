"""Sensor time-series pipelines on Spark: bronze batches, dimensions, fact, daily statistics, alerts."""
