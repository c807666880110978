"""gleaner: a PySpark-native engine for turning raw web postings into clean,
searchable tables.

Sub-packages
------------
functions   Column -> Column rules (text cleaning, wages, dates, urls).
operators   DataFrame -> DataFrame operators (chunking, conform, lake upserts,
            budgets, vectors, html extraction, message codecs, warehouse CRUD).
sources     topic envelopes, url frontier, fetch results, tables.
streaming   Structured Streaming wrappers (micro-batch, drain, staged pipeline).
plans       the registered query catalogue and its DuckDB oracle SQL.
"""

import sys as _sys


def _ship_by_value() -> None:
    """Pickle this package's functions by value for Python workers.

    Arrow passes (pandas_udf / mapInPandas) run our functions on executors
    that need not have the package on their path; shipping the code with the
    closure makes every worker self-sufficient.
    """
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # older cloudpickle: workers then need the package installed
        pass


_ship_by_value()

from gleaner.session import checkpoint_dir, get_spark  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
