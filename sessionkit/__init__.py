"""sessionkit: session analytics on click events, built on Spark DataFrames,
SQL expressions and MLlib.

Entry points: ``sessionkit.operators`` (sessions, profiling, segmentation),
``sessionkit.plans`` (model preparation, training, tuning, reports, end-to-end
paths), ``sessionkit.sources`` (schemas, scans and sinks),
``sessionkit.streaming`` (incremental ingestion) and ``sessionkit.cli``.
"""

__version__ = "0.1.0"
