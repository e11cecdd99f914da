"""Written intermediates in the folder that all executors share."""

from __future__ import annotations

import threading
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..store import dropped, landed

#: Shuffle files of a write are not needed once its table stands; batches of whole texts for Python are kept small.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


_lock, _writers, _before = threading.Lock(), Counter(), {}


@contextmanager
def _writing(spark: SparkSession):
    """The session's settings while any table is written; the last writer puts back what the first one found."""
    with _lock:
        if not _writers[spark]:
            _before[spark] = {k: spark.conf.get(k, None) for k in WHILE_WRITING}
            for k, v in WHILE_WRITING.items():
                spark.conf.set(k, v)
        _writers[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _writers[spark] -= 1
            if not _writers[spark]:
                for k, v in _before.pop(spark).items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends there, so that a lost executor
    costs a read and not the jobs before. The files go when the application ends, or with discard()."""
    with _writing(df.sparkSession):
        return landed(df, name, "zstd")


discard = dropped
