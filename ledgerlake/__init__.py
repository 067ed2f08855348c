"""ledgerlake: multi-source financial analytics as Spark DataFrame jobs.

Layers, each a module of pure ``DataFrame -> DataFrame`` functions:

* ``sources``   raw tables (landed JSON, seeds, derived test tables, NetSuite pulls)
* ``functions`` reusable ``Column`` expressions (surrogate keys, money, dates, JSON)
* ``operators`` generic building blocks (vault loaders, upsert, SCD2, checks, windows)
* ``plans``     the jobs: staging, intermediate, marts, data quality, vault
* ``sinks``     table / partitioned / incremental writers
* ``streaming`` incremental landing of raw files with Structured Streaming
"""

from ledgerlake.params import RunParams

__all__ = ["RunParams"]
