"""Lloyd's clustering around centroids, exact in integers, with geometrically tightened bounds.

Each vector keeps an upper bound of the distance to its own centroid and a lower bound of the
distance to every other one. When centroids move, the lower bound need not fall by their full
drift: the vectors of a cluster lie in a sphere around its old centroid, and within that sphere
the distance to another centroid that moved from p to q shrinks by less than |pq|. The points
where it shrinks by f form one branch of a hyperbola with foci p and q, inside the cone of its
asymptotes, whose angle to the axis pq has the cosine f / |pq|. In the plane through p, q and
the sphere's centre, the sphere is seen from the middle of pq under a known angle, so f is at
most |pq| * cos(angle of the centre - half the angle of the sphere), and never below 0.

A vector whose upper bound stays clearly below its lower bound keeps its cluster unread. The
others first get the exact distance to their own centroid and, where that does not decide,
are scanned against all centroids in exact integers; equal distances go to the smaller number.

Spark holds the vectors in blocks of BLOCK, written once a round beside their bounds; each block
adds, per cluster, the change of its sum and number of vectors and its radius, so that only
clusters times dimensions numbers reach the driver.

Defined cases: a vector is kept if it has DIMENSIONS components, none null or not finite; others
give no row. Components are floor(256 * x), held within +-2**27 so that squared distances fit a
long. Null or repeated vec_ids are rows like others; among equal start hashes the smaller vector
comes first and a null vec_id last. With fewer vectors than centroids every vector is a start.
An empty table gives no rows; other columns are ignored; an inertia above a long becomes its largest value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm.common import dropped, settled

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Vectors in a block, one row of the tables in between.
BLOCK = 4096
MOST = 2**27
#: Sums of products of components below this are exact in doubles.
DOUBLES = 2**22
LONGEST = 2**63 - 1
BLOCKS = "ids array<bigint>, vectors binary, clusters binary, upper binary, lower binary, stats array<struct<cluster:int,n:bigint,total:array<bigint>,radius:double,inertia:decimal(38,0)>>"


def valid(embedding: Column, dimensions: int = DIMENSIONS) -> Column:
    """True for the right number of components, all of them finite."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(embedding) == dimensions) & finite, F.lit(False))


def scaled(embedding: Column) -> Column:
    """Integers floor(256 * x); the bounds of the double come first, as a cast of more would fail."""
    return F.transform(embedding, lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * 256))).cast("long"))


def kept(table: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and the kept vectors' doubles."""
    v = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return v.where(valid(F.col("v"), dimensions))


def starts(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The scaled vectors with the smallest hashes; count of them reach the driver."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(name.alias("h"), scaled(F.col("v")).alias("v")).orderBy(F.asc_nulls_last("h"), "v").limit(count)
    return np.array([r["v"] for r in first.collect()], dtype=np.int64)


# --- inside a task ------------------------------------------------------------


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < DOUBLES:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * xf @ cf.T + (cf * cf).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def own_squares(x: np.ndarray, c: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((x - c[at]) ** 2).sum(1)


def clearly_below(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Below by more than what rounding of the bounds can make up."""
    return upper * (1 + 1e-9) + 1e-6 < lower


def assign(x: np.ndarray, c: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroids and new bounds; at < 0 marks vectors without a centroid yet."""
    at, upper, lower = at.copy(), upper.copy(), lower.copy()
    open_ = np.flatnonzero(~((at >= 0) & clearly_below(upper, lower)))
    had = open_[at[open_] >= 0]
    if len(had):
        upper[had] = np.sqrt(own_squares(x[had], c, at[had]))
        open_ = open_[~((at[open_] >= 0) & clearly_below(upper[open_], lower[open_]))]
    if len(open_):
        d = squares(x[open_], c)
        best = d.argmin(1)  # the first of equals
        rows = np.arange(len(open_))
        at[open_], upper[open_] = best, np.sqrt(d[rows, best])
        d[rows, best] = LONGEST
        lower[open_] = np.sqrt(d.min(1))
    return at, upper, lower


def stats_of(x: np.ndarray, old: np.ndarray, new: np.ndarray, upper: np.ndarray, squares_: np.ndarray | None = None) -> list[dict]:
    """Per cluster the change of number and sum by vectors that came or went, and the radius of the new members."""
    moved = np.flatnonzero(old != new)
    out = []
    for cluster in np.union1d(np.unique(new), old[moved][old[moved] >= 0]):
        come, gone = moved[new[moved] == cluster], moved[old[moved] == cluster]
        mine = new == cluster
        total = x[come].sum(0) - x[gone].sum(0) if len(come) or len(gone) else None
        out.append(
            {
                "cluster": int(cluster),
                "n": len(come) - len(gone),
                "total": None if total is None else total.tolist(),
                "radius": float(upper[mine].max(initial=0)),
                "inertia": None if squares_ is None else int(squares_[mine].astype(object).sum()),
            }
        )
    return out


def _binary(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


_BLOCK_TYPE = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("vectors", pa.binary()),
        ("clusters", pa.binary()),
        ("upper", pa.binary()),
        ("lower", pa.binary()),
        ("stats", pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64())), ("radius", pa.float64()), ("inertia", pa.decimal128(38, 0))]))),
    ]
)


def _block(ids: list, x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, stats: list[dict]) -> pa.RecordBatch:
    row = {"ids": ids, "vectors": _binary(x.astype(np.int32)), "clusters": _binary(at.astype(np.int32)), "upper": _binary(upper), "lower": _binary(lower), "stats": stats}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK_TYPE)


def first_round(centroids: np.ndarray):
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
                x = np.floor(np.clip(values * 256, -MOST, MOST)).astype(np.int64)
                none = np.full(len(x), -1)
                at, upper, lower = assign(x, centroids, none, np.zeros(len(x)), np.zeros(len(x)))
                yield _block(part.column(0).to_pylist(), x, at, upper, lower, stats_of(x, none, at, upper))

    return run


def _unpacked(row: dict, dimensions: int) -> tuple:
    x = np.frombuffer(row["vectors"], np.int32).reshape(-1, dimensions).astype(np.int64)
    return x, np.frombuffer(row["clusters"], np.int32).astype(np.int64), np.frombuffer(row["upper"]), np.frombuffer(row["lower"])


def next_round(centroids: np.ndarray, drift: np.ndarray, loosened: np.ndarray, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("ids", "vectors", "clusters", "upper", "lower")}
                x, old, upper, lower = _unpacked(row, centroids.shape[1])
                at, upper, lower = assign(x, centroids, old, upper + drift[old], lower - loosened[old])
                squares_ = own_squares(x, centroids, at) if last else None
                yield _block(row["ids"], x, at, upper, lower, stats_of(x, old, at, upper, squares_))

    return run


def to_rows(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("ids", "vectors", "clusters", "upper", "lower")}
                x, at, _, _ = _unpacked(row, centroids.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(at.astype(np.int32)), pa.array(own_squares(x, centroids, at))], ["vec_id", "cluster", "distance"]
                )

    return run


# --- on the driver: clusters times dimensions numbers ---------------------------


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster the most by which the distance from a vector of its sphere to any other centroid can shrink."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    axis, middle = new - old, (new + old) / 2
    drift = np.sqrt((axis**2).sum(1))
    out = np.zeros(len(old))
    for i in range(len(old)):
        to = old[i] - middle  # from the middle of each other centroid's way to the centre of this sphere
        far = np.sqrt((to**2).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip((to * axis).sum(1) / (far * drift), -1, 1))
            half = np.arcsin(np.clip(radius[i] / far, 0, 1))
            shrink = drift * np.clip(np.cos(np.maximum(angle - half, 0)), 0, 1)
        shrink = np.where((drift == 0) | (np.arange(len(old)) == i), 0.0, np.where(radius[i] < far, shrink, drift))
        out[i] = shrink.max(initial=0) * (1 + 1e-9) + 1e-6 * (shrink.max(initial=0) > 0)
    return out


def _collected(blocks: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, list[list[int]], np.ndarray, list[int]]:
    """Sums over blocks: one row per cluster comes back."""
    s = blocks.select(F.explode("stats").alias("s")).select("s.*")
    n, radius, inertia = np.zeros(k, dtype=np.int64), np.zeros(k), [0] * k
    sums = [[0] * dimensions for _ in range(k)]
    for r in s.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("inertia").alias("inertia")).collect():
        n[r["cluster"]], radius[r["cluster"]], inertia[r["cluster"]] = r["n"], r["radius"], int(r["inertia"] or 0)
    cells = s.select("cluster", F.posexplode("total").alias("at", "x"))
    for r in cells.groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        sums[r["cluster"]][r["at"]] = int(r["x"])
    return n, sums, radius, inertia


def cluster(table: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark: SparkSession = table.sparkSession
    # a block is a row of a megabyte: few of them at a time go to Python
    small = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}
    read = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(4 * BLOCK)}
    vectors = kept(table, dimensions)
    centroids = starts(vectors, count, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    k = len(centroids)
    blocks = settled(vectors.mapInArrow(first_round(centroids), BLOCKS), "clusters", read)
    n, sums, radius, _ = _collected(blocks, k, dimensions)
    for step in range(rounds):
        moved = np.array([[t // int(n[c]) for t in sums[c]] if n[c] else centroids[c].tolist() for c in range(k)], dtype=np.int64)
        drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        run = next_round(moved, drift, loosening(centroids, moved, radius), step == rounds - 1)
        before, blocks = blocks, settled(blocks.mapInArrow(run, BLOCKS), "clusters", small)
        dropped(before)
        change, added, radius, inertia = _collected(blocks, k, dimensions)
        n, sums = n + change, [[a + b for a, b in zip(x, y)] for x, y in zip(sums, added)]
        centroids = moved
    rows = [(c, min(inertia[c], LONGEST), min(sum(inertia), LONGEST), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in range(k)]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = settled(blocks.mapInArrow(to_rows(centroids), "vec_id bigint, cluster int, distance bigint"), "clustered", small)
    return out.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
