"""homestat: housing-market analytics as Spark DataFrame plans.

Subpackages: `functions` (column rules and labels), `operators` (generic
operators), `sources` (scans, cleaning, sinks, history, health), `plans`
(metrics, report sections, weekly job, registered queries), `streaming`
(incremental landing ingest).
"""

__version__ = "0.1.0"
