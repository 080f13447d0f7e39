"""S4–S9: saved results, BI CSV extracts, result sinks and exports.

A result is a folder of versions (``version=<n>/``, Parquet) and of manifests
(``manifest/<n>.json``, one small file per version that names its data files).  The
manifest appears by a rename after all data are committed, and readers go by
manifests alone: a running, failed or half-written version is never read, whatever
the committer shows early, nor are files that a lost attempt left in a finished
version.  Old versions go when a newer one is finished (:func:`retain`).

JSON and CSV are exchange formats.  Saved JSON comes in two forms, an object per line
and a whole-file array of objects; both are read with the declared schema, and what
does not fit it is told (:data:`BAD_ROW`), never NULL in silence.

Paths may be any Hadoop-compatible URI.  Manifests are written and versions removed
through Hadoop's file system, so these need a classic (not a Connect) session.
"""

from __future__ import annotations

import json
import re
import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
#: The column of rows that do not fit: the row as it was read, NULL for good ones.
BAD_ROW = "_bad_row"
#: The row number that :func:`ingest_extract` adds, so that equal rows can be told apart.
ROW = "_row"
KEEP_VERSIONS = 3


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# ── versions and manifests ──────────────────────────────────────────────────


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str, pattern: str) -> list[int]:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    found = (re.fullmatch(pattern, f.getPath().getName()) for f in fs.listStatus(at))
    return sorted(int(m.group(1)) for m in found if m)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of a result, those with a manifest, oldest first."""
    return _names(spark, f"{path.rstrip('/')}/manifest", r"(\d+)\.json")


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def manifest_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/manifest/{version}.json"


def finish_version(spark: SparkSession, path: str, version: int) -> None:
    """Write the manifest of a version whose data are committed; by a rename, so it is there whole or not at all."""
    files = [f.rsplit("/", 1)[-1] for f in spark.read.parquet(version_path(path, version)).inputFiles()]
    fs, final = _fs(spark, manifest_path(path, version))
    _, draft = _fs(spark, f"{path.rstrip('/')}/manifest/draft-{version}")
    out = fs.create(draft, True)
    try:
        out.write(json.dumps({"version": version, "files": sorted(files)}).encode())
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise OSError(f"version {version} of {path} is finished already")


def read_version(spark: SparkSession, path: str, version: int, schema: T.StructType) -> DataFrame:
    """A finished version: the files that its manifest names, and no others."""
    told = spark.read.schema("version long, files array<string>").json(manifest_path(path, version)).first()
    return spark.read.schema(schema).parquet(*[f"{version_path(path, version)}/{f}" for f in told.files])


def retain(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS) -> list[int]:
    """Remove all but the last ``keep`` finished versions, and what was left unfinished before these; returns what went.

    The manifest goes first, so no reader begins with a version that is being
    removed; a reader that began earlier has ``keep`` - 1 newer writes to end.
    Unfinished versions newer than the oldest kept may still be written and stay.
    """
    finished = versions(spark, path)
    if keep < 1 or len(finished) <= keep:
        return []
    oldest = finished[-keep]
    gone = [v for v in _names(spark, path, r"version=(\d+)") if v < oldest]
    for version in gone:
        for name, recursive in ((manifest_path(path, version), False), (version_path(path, version), True)):
            fs, at = _fs(spark, name)
            fs.delete(at, recursive)
    return gone


def write_result(df: DataFrame, path: str, keep: int = KEEP_VERSIONS) -> str:
    """S6 — a new version of one named result, all its rows; returns the version's path."""
    spark, version = df.sparkSession, time.time_ns()
    df.write.parquet(version_path(path, version))
    finish_version(spark, path, version)
    retain(spark, path, keep)
    return version_path(path, version)


def write_if_absent(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """S7 — an empty result with the declared schema where none was ever finished, so readers keep working."""
    if not versions(spark, path):
        write_result(empty(spark, schema), path)


def write_or_keep(spark: SparkSession, build, schema: T.StructType, path: str) -> str:
    """S6/S7 — write ``build()``; on failure the last good result stays (an empty one if there is none), and the error goes on."""
    try:
        return write_result(build(), path)
    except Exception:
        write_if_absent(spark, schema, path)
        raise


# ── saved results ───────────────────────────────────────────────────────────


def load_result(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """S4 — a saved result with its declared schema; an absent one reads as empty.

    ``fmt='parquet'`` reads the last finished version.  ``fmt='json'`` reads either
    form of saved JSON and fails on the first row that does not fit the schema; use
    :func:`read_saved_json` to keep such rows apart instead.
    """
    if fmt == "json":
        rows = read_saved_json(spark, path, schema)
        bad = F.concat(F.lit(f"{path}: a row does not fit the schema: "), BAD_ROW)
        # Every column carries the check, so none can be read without it.
        return rows.select(*[F.when(F.col(BAD_ROW).isNotNull(), F.raise_error(bad).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) for f in schema])
    found = versions(spark, path)
    return read_version(spark, path, found[-1], schema) if found else empty(spark, schema)


def is_json_array(spark: SparkSession, path: str) -> bool:
    """Whether saved JSON begins with '[', so is a whole-file array."""
    first = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.ltrim("value"), 1, 1)).first()
    return first is not None and first[0] == "["


def _fits(name: str, kind: T.DataType) -> tuple[Column, Column]:
    """A text column as the declared type, and whether a text that is there does not fit it."""
    text = F.col(f"_text.{name}")
    if isinstance(kind, T.StringType):
        return text, F.lit(False)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        value = F.from_json(text, kind)
    else:
        value = F.nullif(F.trim(text), F.lit("")).try_cast(kind)
    return value, F.coalesce(F.trim(text) != "", F.lit(False)) & value.isNull()


def read_saved_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Saved JSON with the declared columns and ``BAD_ROW``.

    Values are read as text and cast here, once, so numbers that were saved as text
    (as a warehouse's command line prints them) read as numbers; '' in a column that
    is not text reads as NULL.  A row that is not JSON, or has a value that does not
    fit its type, has all columns NULL and itself in ``BAD_ROW``.  A key that is
    absent reads as NULL, one that is not declared is left out.  An array is one
    value and is read by one task a file: convert a large one with :func:`write_result`.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(BAD_ROW, T.StringType())])
    try:
        raw = (spark.read.schema(as_text).option("multiLine", is_json_array(spark, path)).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", BAD_ROW).json(path))
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return empty(spark, schema).withColumn(BAD_ROW, F.lit(None).cast("string"))
        raise
    row = F.struct(*[F.col(f.name) for f in schema])
    rows = raw.select(row.alias("_text"), F.col(BAD_ROW).alias("_broken"))
    fits = {f.name: _fits(f.name, f.dataType) for f in schema}
    bad = F.lit(False)
    for _, wrong in fits.values():
        bad = bad | wrong
    rows = rows.withColumn(BAD_ROW, F.coalesce("_broken", F.when(bad, F.to_json("_text"))))
    good = F.col(BAD_ROW).isNull()
    return rows.select(*[F.when(good, value).alias(name) for name, (value, _) in fits.items()], BAD_ROW)


# ── extracts ────────────────────────────────────────────────────────────────


def read_extract(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S5 — a BI CSV extract: header row, every column text, columns known only at run time.

    Quoted fields may hold commas and, with ``multi_line``, line ends; such a file
    is read by one task, so convert large ones once with :func:`ingest_extract`, or
    turn it off where no field holds a line end and the file is split.  Malformed
    UTF-8 decodes to U+FFFD; an empty or absent file is an empty frame.  Short rows
    read with NULLs and long ones are cut; :func:`read_extract_rows` tells them.
    """
    rows = read_extract_rows(spark, path, multi_line)
    return rows.drop(BAD_ROW)


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("multiLine", multi_line).option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("escape", '"')


def read_extract_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """An extract with the column ``BAD_ROW``: a row whose number of fields is not the header's, as it was read."""
    try:
        columns = _csv(spark, multi_line).option("header", True).csv(path).columns
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return spark.createDataFrame([], T.StructType([]))
        raise
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BAD_ROW]])
    return _csv(spark, multi_line).option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", BAD_ROW).schema(schema).csv(path)


def ingest_extract(spark: SparkSession, path: str, out: str, multi_line: bool = True) -> DataFrame:
    """The good rows of an extract as a version of ``out`` in Parquet (all columns text), read again; bad ones go to ``<out>-bad``.

    ``ROW`` numbers the rows, so that equal ones keep an order and pages of them
    neither repeat nor lose any.  Queries on the result are pruned and split.  The
    CSV is read twice, once for either kind.
    """
    rows = read_extract_rows(spark, path, multi_line)
    if not rows.columns:
        return rows
    bad = rows.select(BAD_ROW, *[c for c in rows.columns if c != BAD_ROW]).where(F.col(BAD_ROW).isNotNull())
    write_result(bad, f"{out.rstrip('/')}-bad")
    good = rows.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW).withColumn(ROW, F.monotonically_increasing_id())
    write_result(good, out)
    return load_result(spark, out, good.schema)


# ── exports ─────────────────────────────────────────────────────────────────


def flat(df: DataFrame, sep: str = ", ") -> DataFrame:
    """Every column as CSV can hold it: lists of text joined by ``sep``, other nested values as JSON."""

    def column(f: T.StructField) -> Column:
        kind = f.dataType
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.MapType)):
            return F.array_join(F.col(f.name).cast("array<string>"), sep)
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(f.name)
        return F.col(f.name)

    return df.select(*[column(f).alias(f.name) for f in df.schema])


def export_csv(df: DataFrame, path: str) -> None:
    """S9 — CSV export of a view (header row; nested values by :func:`flat`; NULL and '' are both empty fields)."""
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON-lines export of a result (one object per row)."""
    df.write.mode("overwrite").json(path)
