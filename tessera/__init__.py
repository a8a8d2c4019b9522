"""tessera: warehouse data jobs as Spark DataFrame / Structured Streaming
operators.  Typical entry points:

* clinical reports: ``tessera.plans.clinical`` (readmissions, scorecard, ...)
* loads: ``tessera.plans.loads`` (SCD2, claims MERGE, encounter append)
* product marts: ``tessera.plans.product``; staging: ``tessera.plans.staging``
* quality: ``tessera.plans.quality``, data tests: ``tessera.plans.assertions``
* streams: ``tessera.streaming.claims``, ``.activity``, ``.aggregates``
* building blocks: ``tessera.operators`` (merge, dedup, rolling, sequence,
  sinks, vault) and ``tessera.functions`` (column helpers, calendar)
"""

__version__ = "0.1.0"
