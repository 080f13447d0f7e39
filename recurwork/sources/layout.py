"""Bucketed tables: W and the facts laid out by work order, so that joining them moves neither.

Every report that reads W joins it to a fact on ``tracking_nbr``.  Written once in the
same number of buckets by that key, both sides of each join are read bucket by
bucket: no exchange, however often they are joined.  A table is written from a hash
partitioning by the key, so a bucket is one file, and sorted, so the sort before the
join finds its rows in order.

Buckets are declared in the session's catalog, the files lie under a path; another
session declares them again with :func:`open_bucketed`.  A write is a new folder, and
the folder's name holds what a reader must know: the key and the number of buckets.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurwork.sources.files import _fs

KEY = "tracking_nbr"
BUCKET_BYTES = 256 << 20


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A number of buckets for the larger side of the join: a power of two, so that smaller tables can have fewer."""
    return 1 << max(0, -(-table_bytes // bucket_bytes) - 1).bit_length()


def write_bucketed(df: DataFrame, path: str, buckets: int, key: str = KEY, name: str = "bucketed", keep: int = 2) -> str:
    """Write ``df`` in ``buckets`` by ``key``, sorted by it; returns the folder.  The last ``keep`` folders of a name stay.

    Rows without a key match nothing, but LEFT joins keep them: they are one bucket's
    rows, so leave them out where no report needs them.
    """
    at = f"{path.rstrip('/')}/{name}-by-{key}-in-{buckets}-at-{time.time_ns()}"
    table = _table(at)
    try:
        (df.repartition(buckets, F.col(key)).write.format("parquet").option("path", at)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    fs, folder = _fs(df.sparkSession, path)
    older = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith(f"{name}-by-")]
    for gone in sorted(older, key=lambda p: int(p.getName().rsplit("-", 1)[-1]))[:-keep]:
        fs.delete(gone, True)
    return at


def _table(at: str) -> str:
    return "bucketed_" + re.sub(r"\W", "_", at.rstrip("/").rsplit("/", 1)[-1])


def open_bucketed(spark: SparkSession, at: str) -> DataFrame:
    """A folder of :func:`write_bucketed` with its buckets declared."""
    told = re.search(r"-by-(\w+)-in-(\d+)-at-\d+/?$", at)
    if told is None:
        raise ValueError(f"{at} is no folder of write_bucketed")
    key, buckets = told.groups()
    table = _table(at)
    if not spark.catalog.tableExists(table):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(at).schema)
        spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{at}'")
    return spark.table(table)
