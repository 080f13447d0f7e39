"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from recurwork.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the plan
    below.  The folder's own retention removes the table after the job.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[list[list]], list[list]], schema: str, arrow: pa.Schema) -> DataFrame:
    """``fn`` over bounded runs of rows: columns in as lists, columns out as lists.

    Rows arrive in Arrow batches; a batch is cut so that a call sees at most
    ``SLICE_BYTES`` of data or one row, whichever is more, and memory does not
    grow with the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    step = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
