"""Telemetry analytics on Spark: DataFrame operators, sources and plans."""
