"""rowtide: change-data-capture tables on Spark.

Debezium-style change envelopes in, query-ready tables out: parse and
quarantine, flatten, latest-per-key, route, cast to contracts, merge
(replace / update / soft and physical delete / SCD2), replay, ledger,
drift checks, fan-out and pipeline metrics. Everything is DataFrame
expressions; no Python UDFs, no driver-side row loops.
"""

__version__ = "0.1.0"
