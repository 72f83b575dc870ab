"""ledgerstar: a retail star-schema warehouse built from PySpark DataFrame operators.

Layers, in build order:

* ``sources``    landing of headerless delimited files, bronze extract, load reconciliation
* ``operators``  reusable DataFrame operators (staging specs, intervals and as-of joins,
                 SCD2, star-schema helpers, scalable global windows, quality gates,
                 incremental merge)
* ``plans``      the warehouse itself: roles over the input tables, dimensions, facts,
                 marts and the business queries on top of them
* ``streaming``  the micro-batch form of the incremental load
* ``functions``  Column-level helpers shared by all of the above

Every operator takes and returns DataFrames and stays inside Catalyst: no Python UDF
runs in any hot path.
"""

from ledgerstar.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
