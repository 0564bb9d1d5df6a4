"""sparkmart: retail ingestion, features, profiling and mining as Spark jobs.

Entry points: :mod:`sparkmart.ingest` (batch ingestion, also a CLI),
:mod:`sparkmart.streaming.landing` (incremental ingestion),
:mod:`sparkmart.operators.features` (customer features, baskets),
:mod:`sparkmart.mining` (K-Means, decision tree, FP-Growth),
:mod:`sparkmart.end_to_end` (end-to-end), :mod:`sparkmart.plans` (query registry).
"""

__version__ = "0.1.0"
