"""tessera: training-data preparation and run analytics as Spark DataFrame jobs.

Every public operator is either a ``Column`` builder (``tessera.functions``)
or a ``DataFrame -> DataFrame`` function (``tessera.operators``) that can be
chained with ``DataFrame.transform``.  Sources and sinks live in
``tessera.sources``, streaming queries in ``tessera.streaming`` and the
registered query plans (with their DuckDB oracles) in ``tessera.plans``.
"""

__version__ = "0.1.0"
