"""clipmart: document-shaped model output about media assets, turned into
queryable tables and asked questions of, as Spark DataFrame / SQL / Structured
Streaming jobs.

Layout
------
sources/    readers and writers (parquet, CSV seeds, JSON logs, binary landing)
functions/  column expressions (identity hashes, ids, vectors, tokens, p-values)
operators/  DataFrame -> DataFrame operators (silver, gold, perf, stats, search,
            assemble, dq, lineage, incremental, reconcile)
plans/      whole jobs, fixtures derived from the driver tables, query registry
streaming/  the incremental jobs as Structured Streaming queries
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers (pandas
    UDFs, mapInPandas) need no installed copy of the package: the task
    carries the code it runs."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark absent
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
