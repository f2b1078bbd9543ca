"""ladle: a Spark-native engine for preparing and evaluating instruction-tuning data.

Everything is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function:

* ``ladle.functions``  scalar text / JSON columns (no UDFs)
* ``ladle.operators``  rendering, validation, splits, pairing, scoring, summaries
* ``ladle.sources``    CSV / text / JSON / JSONL scans and sinks
* ``ladle.streaming``  incremental ingest with Structured Streaming
* ``ladle.plans``      fixture views over the test tables and the registered queries
"""

from ladle.session import configure, get_session

__all__ = ["configure", "get_session"]
