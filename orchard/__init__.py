"""orchard - churn and recommendation analytics as Spark DataFrame jobs.

Operators live in ``orchard.operators`` (DataFrame -> DataFrame functions), readers and sinks
in ``orchard.sources``, column expressions in ``orchard.functions``, streaming jobs in
``orchard.streaming`` and the named queries / end-to-end jobs in ``orchard.plans``.
"""

__version__ = "0.1.0"
