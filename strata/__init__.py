"""strata: a layered real-time retail warehouse on Spark.

Every operator is a DataFrame-in, DataFrame-out function that works on both
bounded tables and Structured Streaming inputs.  Layers:

- ``strata.functions``  Column -> Column scalar helpers (dates, money, JSON, labels)
- ``strata.sources``    topic records, dimension stores, sinks, test-data views
- ``strata.operators``  routing, decoding, dimension upsert, enrichment, wide join,
                        apportionment, device activity, dashboard aggregates
- ``strata.plans``      the query catalogue and its SQL oracles
- ``strata.streaming``  per-hop streaming jobs and the stateful apportioner
"""

__version__ = "0.1.0"
