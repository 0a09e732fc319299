"""kvloom: telemetry re-modelling as Spark jobs.

Entity-key-time rows with typed value columns go in; three keyed tables come
out: bucketed history, a bucket index and the latest value per key.
"""
