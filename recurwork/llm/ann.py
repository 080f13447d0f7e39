"""Nearest neighbours by stable projections, a kd-tree and a chi-square test.

Vectors are projected to ``DIMS`` dimensions by Gaussian (2-stable) directions:
the squared projected distance of two vectors over their squared distance follows
a chi-square law with DIMS degrees of freedom.  The projected points are indexed
by a kd-tree; its top levels (planes from a bounded sample, see ``sample_rows``)
cut the points into cells that are dealt over the cluster, its lower levels are
built inside each cell.  Per query the leaves are taken in order of projected
distance, their points are verified by true distance, and the search stops when a
point not yet seen, if it were as near as the k-th best, would have been seen with
probability ``sure``.

A query first searches its own cell, then, with the k-th distance found there as
bound, the cells whose boxes the test does not rule out.  The top has at most
``sample_rows / 16`` cells; a cell of more than ``cell_rows`` points is dealt into
shares of about that many by a hash of the vector, each with a tree of its own, and
a query takes the best of all shares.  Queries meet a share in blocks, as many as
those that ask for its cell need, so neither side of a task grows with the table and
a cell that no query asks for is not sent.

Equal vectors are indexed once, with their k + 1 smallest ids (no query needs
more), so a very common vector costs one point.  Vectors that are null, zero, of
another length than most, or that hold null or non-finite components take no
part.  Rows that repeat an id and its vector count once; an id with two vectors is
two candidates.  Ties go to the smaller id.  A vector may be of any length that fits in a
row.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from recurwork.llm.common import map_rows, written

#: Projected dimensions (even, for the closed form of the law), points of a leaf.
DIMS, LEAF = 12, 32


def chi_square(x: float) -> float:
    """Probability that a chi-square variable of DIMS degrees of freedom is at most ``x``."""
    if x == float("inf"):
        return 1.0
    term = total = 1.0
    for i in range(1, DIMS // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - exp(-x / 2) * total


def reach(sure: float) -> float:
    """The bound on squared projected over squared true distance at which the stopping test holds."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if chi_square(mid) >= sure else (mid, high)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((size, DIMS))


Planes = list[tuple[int, float]]


def planes_of(points: np.ndarray, depth: int) -> Planes:
    """Splits of a complete kd-tree (node i has children 2i+1 and 2i+2), each at the median of the widest axis."""
    out: Planes = []
    level = [points]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            bound = float(np.median(part[:, axis])) if len(part) else 0.0
            out.append((axis, bound))
            below += [part[part[:, axis] <= bound], part[part[:, axis] > bound]]
        level = below
    return out


def cells_of(points: np.ndarray, planes: Planes) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    axes, bounds = np.array([a for a, _ in planes], int), np.array([b for _, b in planes])
    while len(points) and node[0] < len(planes):
        node = 2 * node + 1 + (points[np.arange(len(points)), axes[node]] > bounds[node])
    return node - len(planes)


def leaves_of(points: np.ndarray) -> list[np.ndarray]:
    """Rows of each leaf of the kd-tree inside a cell."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        axis = int(np.argmax(np.ptp(points[rows], axis=0)))
        half = len(rows) // 2
        order = rows[np.argpartition(points[rows, axis], half)]
        todo += [order[:half], order[half:]]
    return out


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (gap * gap).sum(axis=-1)


Found = list[tuple[float, int]]


class Cell:
    """The kd-tree of one cell."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], basis: np.ndarray):
        self.vectors, self.ids, self.points = vectors, ids, vectors @ basis
        self.leaves = leaves_of(self.points) if len(vectors) else []
        self.low = np.array([self.points[r].min(axis=0) for r in self.leaves]).reshape(-1, DIMS)
        self.high = np.array([self.points[r].max(axis=0) for r in self.leaves]).reshape(-1, DIMS)

    def search(self, own: int, vector: np.ndarray, basis: np.ndarray, k: int, ratio: float, bound: float) -> Found:
        """The nearest of this cell, as far as they are within ``bound``."""
        found: Found = []
        point = vector @ basis
        away = box_distance(point, self.low, self.high)
        for leaf in np.argsort(away, kind="stable"):
            if away[leaf] > ratio * bound * bound:  # the stopping test
                break
            rows = self.leaves[leaf]
            gap = self.points[rows] - point
            rows = rows[(gap * gap).sum(axis=1) <= ratio * bound * bound]
            gap = self.vectors[rows] - vector
            true = np.sqrt((gap * gap).sum(axis=1))
            near = [(d, int(i)) for d, r in zip(true.tolist(), rows, strict=True) if d <= bound for i in self.ids[r] if i != own]
            if near:
                found = sorted(found + near)[:k]
                if len(found) == k:
                    bound = min(bound, found[-1][0])
        return found


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, vector`` (array of doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (usual[0]["size"] if usual else 0))


SCHEMA = "query_id long, vec_id long, score double"


def nearest(spark: SparkSession, rows: DataFrame, every: int = 100, k: int = 10, sure: float = 0.97,
            cell_rows: int = 8192, block_rows: int = 2048, sample_rows: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each row whose id is divisible by ``every``."""
    valid = usable(rows).groupBy("vec_id", "vector").agg(F.count("*").alias("n")).drop("n")
    first = Window.partitionBy("vector").orderBy("vec_id")
    points = written(valid.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
                     .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-points")
    queries = valid.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    n_points, size = points.agg(F.count("*"), F.max(F.size("vector"))).collect()[0]
    if not n_points:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    basis, ratio = directions(size), reach(sure)

    # The top of the tree, from a sample of bounded size.
    few = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(min(1.0, sample_rows / n_points) * (1 << 30))
    sample = np.array([r.vector for r in points.where(few).select("vector").limit(2 * sample_rows).collect()]).reshape(-1, size)
    depth = min(int(np.ceil(np.log2(max(1, n_points / cell_rows)))), int(np.log2(sample_rows / 16)))
    planes = planes_of(sample @ basis, depth)

    def with_cell(columns: list[list]) -> list[list]:
        at = cells_of(np.array(columns[0]).reshape(-1, size) @ basis, planes)
        return [*columns, at.tolist()]

    vectors = pa.list_(pa.float64())
    points = written(map_rows(points.select("vector", "ids"), with_cell, "vector array<double>, ids array<long>, cell long",
                              pa.schema([("vector", vectors), ("ids", pa.list_(pa.int64())), ("cell", pa.int64())])), "ann-cells")
    queries = written(map_rows(queries.select("vector", "query_id"), with_cell, "vector array<double>, query_id long, home long",
                               pa.schema([("vector", vectors), ("query_id", pa.int64()), ("home", pa.int64())])), "ann-queries")

    def corners(columns: list[list]) -> list[list]:
        at, projected = np.array(columns[1]), np.array(columns[0]).reshape(-1, size) @ basis
        own = np.unique(at)
        return [own.tolist(), [projected[at == c].min(axis=0).tolist() for c in own], [projected[at == c].max(axis=0).tolist() for c in own]]

    points_of = {r["cell"]: r["count"] for r in points.groupBy("cell").count().collect()}  # at most a row per cell of the top

    edges = map_rows(points.select("vector", "cell"), corners, "cell long, low array<double>, high array<double>",
                     pa.schema([("cell", pa.int64()), ("low", vectors), ("high", vectors)]))
    corner = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(DIMS)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(DIMS)]
    boxes = edges.groupBy("cell").agg(*corner).orderBy("cell").collect()  # a row for each cell, of which there are few
    cells = np.array([b.cell for b in boxes])
    low, high = np.array([b[1:1 + DIMS] for b in boxes]), np.array([b[1 + DIMS:] for b in boxes])

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            cell = Cell(np.stack(left["vector"].to_numpy()), list(left["ids"]), basis)
            for own, vector, bound in zip(right["query_id"], right["vector"], right["bound"], strict=True):
                out += [(own, i, d) for d, i in cell.search(own, np.asarray(vector), basis, k, ratio, bound)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def searched(asked: DataFrame) -> DataFrame:
        """The best k of each query from searches of (query, cell) rows with their bounds."""
        asked = written(asked, "ann-asked")
        dealt = [(r["cell"], -(-points_of[r["cell"]] // cell_rows), -(-r["count"] // block_rows))
                 for r in asked.groupBy("cell").count().collect() if r["cell"] in points_of]
        dealt = F.broadcast(spark.createDataFrame(dealt, "cell long, shares long, blocks long"))  # as many rows as the top has cells

        def numbers(n: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

        left = points.join(dealt, "cell").withColumn("share", F.pmod(F.xxhash64("vector"), "shares")).withColumn("block", numbers("blocks"))
        right = asked.join(dealt, "cell").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks")).withColumn("share", numbers("shares"))
        on = ["cell", "share", "block"]
        found = left.select(*on, "vector", "ids").groupBy(on).cogroup(right.select(*on, "query_id", "vector", "bound").groupBy(on)).applyInPandas(search, SCHEMA)
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")

    at_home = written(searched(queries.select("query_id", "vector", F.col("home").alias("cell"), F.lit(float("inf")).alias("bound"))), "ann-home")
    bounds = at_home.groupBy("query_id").agg(F.max("score").alias("bound"), F.count("*").alias("n"))
    known = queries.join(bounds, "query_id", "left").select(
        "query_id", "vector", "home", F.when(F.col("n") >= k, F.col("bound")).otherwise(float("inf")).alias("bound"))

    def others(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for own, vector, home, bound in zip(*columns, strict=True):
            away = box_distance(np.array(vector) @ basis, low, high)
            for cell in cells[(away <= ratio * bound * bound) & (cells != home)].tolist():
                for column, value in zip(out, (own, vector, cell, bound), strict=True):
                    column.append(value)
        return out

    asked = map_rows(known, others, "query_id long, vector array<double>, cell long, bound double",
                     pa.schema([("query_id", pa.int64()), ("vector", vectors), ("cell", pa.int64()), ("bound", pa.float64())]))
    return (at_home.unionByName(searched(asked)).distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
