"""martflow: a Spark-native rebuild of a real-time retail warehouse.

The package turns behaviour logs and database change-logs into warehouse
detail (DWD) and dimension (DIM) tables.  Every operator is a
``DataFrame -> DataFrame`` function; the stateful ones also have a
Structured Streaming form in :mod:`martflow.streaming`.

Layout
------
``functions``  column expressions (dates, JSON tests, map projections)
``sources``    topic readers, envelope schemas, dictionary scans, test-table adapters
``sinks``      topic writers, keyed upsert and dimension sinks
``operators``  cleaning, traffic (visitor repair, unique visitor, bounce),
               log split, joins, upsert/merge, trade filters
``plans``      the nine warehouse jobs as batch plans + registered queries
``streaming``  stateful processors and micro-batch jobs
"""

from martflow.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
