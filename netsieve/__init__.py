"""Malicious-traffic analytics over heterogeneous security telemetry, on Spark DataFrames."""
