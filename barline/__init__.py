"""barline: Spark-native operators for panel market time series.

Every operator is a lazy DataFrame transformation keyed by ``asset_name``;
nothing is collected to the driver.  Sub-packages:

* ``sources``   – driver tables, fixture views, CSV/Parquet IO, model store
* ``functions`` – Column-expression builders (numeric cleaning, EMA fold, names)
* ``operators`` – cleaning, calendar, indicators, sequences, quality, metrics,
                  drift, exploration, registry, scoring, model jobs
* ``plans``     – composite chains (feature table, preprocessing, training)
                  and the query catalog used by ``__spark_entry__``
* ``streaming`` – Structured Streaming versions of daily close and live scoring
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions and classes by value.

    Grouped maps, ``mapInPandas`` kernels and stateful streaming functions
    close over barline objects (configs, helpers).  Registered by value, they
    reach the Python workers inside the task payload, so executors need only
    pyspark, numpy and pandas, not an installed copy of this package.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark absent
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
