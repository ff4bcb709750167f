"""auditlens: Spark-native auditing of automated yes/no decisions.

Every operator takes and returns DataFrames and is built from Catalyst
expressions, aggregates, windows and joins.  Sub-packages:

* ``functions`` – column-expression helpers (safe casts, bins, normal CDF,
  distributed prefix sums and exact quantiles).
* ``sources``   – table loading, fixture views, raw scans and sinks.
* ``operators`` – the audit operators (labels, features, metrics, fairness…).
* ``plans``     – the query registry used by ``__spark_entry__``.
* ``streaming`` – Structured Streaming monitors.
"""

__version__ = "0.1.0"
