"""Random forests and small boosted models grown from histograms of binned rows; the fitted models are MLlib's.

MLlib's own fit keeps every row as objects in the executors' memory. Here a row is one byte per
feature, in blocks of an Arrow batch that stay on disk, and a level of all trees is one pass over
them: tasks add up their rows per node, feature and bin, and the sums of a node meet in one
place, where its best split is found. Memory is bounded by the sums of a pass, whatever the number
of rows. Nodes that are small with levels to go are grown to the end by one task each, and so are
boosted models of few rows, where rounds of jobs would take far longer than the sums.

Splits are MLlib's: at most ``BINS`` bins of equal shares per feature (all midpoints where there are
fewer values), the largest fall of the variance, whole bootstrap weights, a set of features per node.
"""

from __future__ import annotations

import json
import math
import time
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.session import work_folder

BINS = 32
# Values that a task passes on per feature, and that it holds while it reads.
SUMMARY = 256
SUMMARY_HELD = 1024
# Cells (node, feature, bin) that a pass sums; one cell has three numbers.
PASS_CELLS = 1 << 21
# Cells whose sums travel together: one place gets as many such parts as there are tasks.
PART_CELLS = 1 << 10
# Cells that the growth of a small node sums at once.
LOCAL_CELLS = 1 << 18
# Nodes of so many rows at most are grown by one task if at least so many levels may follow.
LOCAL_ROWS = 20_000
LOCAL_LEVELS = 3
# Rows up to which a boosted model is grown by one task.
BOOST_ROWS = 100_000
# Part of the mean square that a split has to explain; below it, it is noise of the sums.
NOISE = 1e-12

#: Draws of 16 bits as bootstrap weights: Poisson of mean one.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]) * 65536, np.arange(65536), "right").astype(np.uint8)

#: A node while trees grow. Children lie beside each other; a node without a split leads to itself.
NODE = np.dtype([("feature", "<i4"), ("bin", "u1"), ("left", "<i4"), ("n", "<f8"), ("s", "<f8"), ("q", "<f8"), ("gain", "<f8")])
#: Parameters of a single tree in MLlib's files.
TREE_PARAMS = set(
    "cacheNodeIds checkpointInterval featuresCol impurity labelCol leafCol maxBins maxDepth maxMemoryInMB minInfoGain minInstancesPerNode "
    "minWeightFractionPerNode predictionCol seed".split()
)
BEST = "tree int, slot int, feature int, bin int, gain double, n double, s double, q double, n_low double, s_low double, q_low double"


# --- bins ---------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _shortened(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values with counts, as at most ``most`` of them that stand for equal shares."""
    if len(values) <= most:
        return values, counts
    ends = np.cumsum(counts)
    share = np.minimum(((ends - counts / 2) * most / ends[-1]).astype(int), most - 1)
    first = np.flatnonzero(np.diff(share, prepend=-1))
    middle = (first + np.append(first[1:], len(values)) - 1) // 2
    return values[middle], np.add.reduceat(counts, first)


def _merged(parts: Iterable[tuple[np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray]:
    values, counts = (np.concatenate(x) for x in zip(*parts))
    known = ~np.isnan(values)
    distinct, place = np.unique(values[known], return_inverse=True)
    return _shortened(distinct, np.bincount(place, counts[known], len(distinct)), most)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values and counts per feature of a task's rows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            now = [(x, np.ones(len(x))) for x in _matrix(batch.column(0)).T]
            held = [_merged([a, b] if held else [b], SUMMARY_HELD) for a, b in zip(held or now, now)]
    short = [_shortened(*x, SUMMARY) for x in held]
    names = ["feature", "x", "n"]
    kind = pa.list_(pa.float64())
    yield pa.RecordBatch.from_arrays([pa.array(range(len(short)), pa.int32()), *(pa.array([x[i] for x in short], kind) for i in (0, 1))], names=names)


def thresholds(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where a feature is cut: every midpoint if there are few values, else as close to equal shares as they allow."""
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) < BINS:
        return middles
    ends, found = np.cumsum(counts), []
    stride = ends[-1] / BINS
    target = stride
    for i in range(len(middles)):
        if abs(ends[i] - target) < abs(ends[i + 1] - target):
            found.append(middles[i])
            target += stride
    return np.array(found[: BINS - 1])


def _feature_cuts(rows: pd.DataFrame) -> pd.DataFrame:
    cuts = thresholds(*_merged(zip(map(np.asarray, rows["x"]), map(np.asarray, rows["n"])), 16 * SUMMARY))
    return pd.DataFrame({"feature": rows["feature"].iloc[:1], "cuts": [cuts.tolist()]})


def _to_blocks(cuts: Sequence[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            if np.isnan(y).any():
                raise ValueError("labels must not be null or NaN")
            bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["bins", "labels"])

    return step


@dataclass(frozen=True)
class BinnedRows:
    """Rows as blocks of bins on the executors' disks, and the cuts between the bins; use as a context."""

    blocks: DataFrame
    cuts: tuple[np.ndarray, ...]
    rows: int

    def __enter__(self) -> BinnedRows:
        return self

    def __exit__(self, *_: object) -> None:
        self.blocks.unpersist()


def bin_rows(df: DataFrame, label: str, features: str = "features") -> BinnedRows:
    """Bin a frame of vectors; it is read twice, so it should be stored."""
    found = df.select(vector_to_array(features).alias("x")).mapInArrow(_summaries, "feature int, x array<double>, n array<double>")
    cuts = dict(map(tuple, found.groupBy("feature").applyInPandas(_feature_cuts, "feature int, cuts array<double>").collect()))
    if not cuts:
        raise ValueError("a forest needs at least one row")
    ordered = tuple(np.asarray(cuts[f], float) for f in range(len(cuts)))
    blocks = to_blocks(df, ordered, label, features).persist(StorageLevel.DISK_ONLY)
    rows = blocks.agg(F.sum(F.octet_length("labels"))).first()[0] // 8
    return BinnedRows(blocks, ordered, rows)


def to_blocks(df: DataFrame, cuts: Sequence[np.ndarray], label: str, features: str = "features") -> DataFrame:
    """A frame of vectors as blocks of bins and labels."""
    plain = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    return plain.mapInArrow(_to_blocks(cuts), "bins binary, labels binary")


# --- splits -------------------------------------------------------------------


def _sums(slot: np.ndarray, x: np.ndarray, rows: np.ndarray, subset: np.ndarray, stats: Sequence[np.ndarray]) -> np.ndarray:
    """Weights, labels and squares (``stats``) per node, chosen feature and bin."""
    nodes, m = subset.shape
    out = np.zeros((3, nodes, m, BINS))
    for j in range(m):
        cell = slot * BINS + x[subset[slot, j], rows]
        for i, values in enumerate(stats):
            out[i, :, j] = np.bincount(cell, values, nodes * BINS).reshape(nodes, BINS)
    return out


def _best(sums: np.ndarray, subset: np.ndarray, min_rows: int) -> dict[str, np.ndarray]:
    """The split of each node that explains most, the first of equals; feature -1 where none does."""
    nodes = np.arange(sums.shape[1])
    n, s, q = total = sums[:, :, 0].sum(axis=2)
    low = np.cumsum(sums, axis=3)[..., :-1]
    (n_low, s_low), n_high = low[:2], n[:, None, None] - low[0]
    with np.errstate(all="ignore"):
        fall = s_low**2 / n_low + (s[:, None, None] - s_low) ** 2 / n_high
        fall = np.where((n_low >= max(min_rows, 1)) & (n_high >= max(min_rows, 1)), fall, -np.inf).reshape(len(nodes), -1)
        at = np.argmax(fall, axis=1)
        gain = (fall[nodes, at] - s**2 / n) / n
        good = gain > NOISE * q / n
    j, cut = np.divmod(at, BINS - 1)
    parts = low[:, nodes, j, cut]
    return {
        "feature": np.where(good, subset[nodes, j], -1), "bin": cut, "gain": np.where(good, gain, -1.0),
        **dict(zip(("n", "s", "q"), total)), **dict(zip(("n_low", "s_low", "q_low"), parts)),
    }


def _grown(best: dict[str, np.ndarray], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which nodes are split, where their left children lie from ``first`` on, and the children."""
    split = best["feature"] >= 0
    left = first + 2 * (np.cumsum(split) - 1)
    made = np.zeros((int(split.sum()), 2), NODE)
    for k in ("n", "s", "q"):
        made[k][:, 0] = best[f"{k}_low"][split]
        made[k][:, 1] = (best[k] - best[f"{k}_low"])[split]
    made = made.ravel()
    made["feature"], made["gain"] = -1, -1.0
    return split, left, made


def _open(nodes: np.ndarray, min_rows: int) -> np.ndarray:
    """Nodes that may be split: enough rows, and labels that differ."""
    with np.errstate(all="ignore"):
        mean = nodes["q"] / nodes["n"]
        return (nodes["n"] >= 2 * max(min_rows, 1)) & (mean - (nodes["s"] / nodes["n"]) ** 2 > NOISE * mean)


def _subsets(rng: np.random.Generator, nodes: int, features: int, m: int) -> np.ndarray:
    """``m`` features of each node, in their order."""
    if m >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return np.sort(np.argpartition(rng.random((nodes, features)), m, axis=1)[:, :m], axis=1)


def _weights(draw: Sequence[int] | None, n: int) -> np.ndarray:
    """Bootstrap weights of a block for a tree: always the same ones for the same ``draw``."""
    if draw is None:
        return np.ones(n, np.uint8)
    return _POISSON[np.random.Generator(np.random.SFC64(draw)).integers(0, 65536, n, np.uint16)]


def _blocks_of(batch: pa.RecordBatch, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bins per feature and row, labels, and a mark that is always the same for the same block."""
    for bins, labels in zip(batch.column("bins"), batch.column("labels")):
        y, held = np.frombuffer(labels.as_buffer()), bins.as_buffer()
        yield np.frombuffer(held, np.uint8).reshape(features, len(y)), y, zlib.crc32(labels.as_buffer(), zlib.crc32(held))


def _levels(nodes: np.ndarray) -> int:
    """Splits on the longest path; children come after their parents."""
    at, levels = np.zeros(1, int), 0
    while len(at := at[nodes["feature"][at] >= 0]):
        at, levels = np.concatenate([nodes["left"][at], nodes["left"][at] + 1]), levels + 1
    return levels


def _walk(nodes: np.ndarray, x: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after some levels."""
    feature, cut, left = np.maximum(nodes["feature"], 0), nodes["bin"], nodes["left"]
    split = nodes["feature"] >= 0
    cut = np.where(split, cut, 255)
    left = np.where(split, left, np.arange(len(nodes)))
    at = np.zeros(len(rows), np.int64)
    for _ in range(levels):
        at = left[at] + (x[feature[at], rows] > cut[at])
    return at


@dataclass(frozen=True)
class _Pass:
    """What a task needs to know about the trees: their nodes, and the slot of each node that is asked for."""

    trees: dict[int, np.ndarray]
    slots: dict[int, np.ndarray]
    levels: int
    features: int
    seed: int
    bootstrap: bool

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per block and tree: the rows that are drawn and lie in a node asked for, with slots, labels and weights."""
        for batch in batches:
            for x, y, mark in _blocks_of(batch, self.features):
                for tree, nodes in self.trees.items():
                    w = _weights([self.seed & 0xFFFFFFFF, tree, mark] if self.bootstrap else None, len(y))
                    rows = np.flatnonzero(w)
                    slot = self.slots[tree][_walk(nodes, x, rows, self.levels)]
                    asked = slot >= 0
                    rows, slot = rows[asked], slot[asked]
                    if len(rows):
                        yield tree, x, rows, slot, y[rows], w[rows].astype(float)


def _part_nodes(m: int) -> int:
    return max(1, PART_CELLS // (m * BINS))


def _level_sums(step: _Pass, subsets: dict[int, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for tree, x, rows, slot, y, w in step.rows(batches):
            now = _sums(slot, x, rows, subsets[tree], (w, w * y, w * y * y))
            if tree in sums:
                sums[tree] += now
            else:
                sums[tree] = now
        for tree, found in sums.items():
            size = _part_nodes(found.shape[2])
            parts = range(0, found.shape[1], size)
            blobs = [np.ascontiguousarray(found[:, p : p + size]).tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(blobs), pa.int32()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["tree", "part", "sums"]
            )

    return run


def _level_best(subsets: dict[int, np.ndarray], min_rows: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(found: pd.DataFrame) -> pd.DataFrame:
        tree, part = int(found["tree"].iloc[0]), int(found["part"].iloc[0])
        subset = subsets[tree][part : part + _part_nodes(subsets[tree].shape[1])]
        total = np.zeros((3, *subset.shape, BINS))
        for blob in found["sums"]:
            total += np.frombuffer(blob).reshape(total.shape)
        return pd.DataFrame({"tree": tree, "slot": part + np.arange(len(subset)), **_best(total, subset, min_rows)})

    return run


# --- small nodes --------------------------------------------------------------


def _small_rows(step: _Pass) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of small nodes: one record per block, tree and node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, x, rows, slot, y, w in step.rows(batches):
            order = np.argsort(slot, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(slot[order])) + 1, len(order))
            parts = [order[a:b] for a, b in zip([0, *ends[:-1]], ends)]
            blobs = [[x[:, rows[p]].tobytes(), y[p].tobytes(), w[p].tobytes()] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(parts), pa.int32()), pa.array([int(slot[p[0]]) for p in parts], pa.int32()), *(pa.array(c, pa.binary()) for c in zip(*blobs))],
                names=["tree", "slot", "bins", "labels", "weights"],
            )

    return run


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int, m: int, min_rows: int, rng: np.random.Generator) -> np.ndarray:
    """A tree on rows that fit one task, all nodes of a level at once."""
    stats = np.stack([w, w * y, w * y * y])
    nodes = np.zeros(1, NODE)
    nodes["feature"], nodes["gain"] = -1, -1.0
    for k, total in zip(("n", "s", "q"), stats.sum(axis=1)):
        nodes[k] = total
    rows, slot = np.arange(len(y)), np.zeros(len(y), int)
    waiting = np.flatnonzero(_open(nodes, min_rows))
    made = [nodes]
    size = 1
    for _ in range(levels):
        if not len(waiting):
            break
        subset = _subsets(rng, len(waiting), len(x), m)
        chunk = max(1, LOCAL_CELLS // (m * BINS))
        found = []
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        for a in range(0, len(waiting), chunk):
            at = slice(*np.searchsorted(slot, [a, a + chunk]))
            some = subset[a : a + chunk]
            found.append(_best(_sums(slot[at] - a, x, rows[at], some, stats[:, rows[at]]), some, min_rows))
        best = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
        split, left, children = _grown(best, size)
        whole = np.concatenate(made)
        whole["feature"][waiting], whole["gain"][waiting] = best["feature"], best["gain"]
        whole["bin"][waiting], whole["left"][waiting] = best["bin"], np.where(split, left, 0)
        made = [whole, children]
        going = split[slot]
        rows, slot = rows[going], slot[going]
        child = left[slot] - size + (x[best["feature"][slot], rows] > best["bin"][slot])
        opened = _open(children, min_rows)
        going = opened[child]
        rows, slot = rows[going], (np.cumsum(opened) - 1)[child[going]]
        waiting = size + np.flatnonzero(opened)
        size += len(children)
    return np.concatenate(made)


def _grow_small(levels: dict[int, np.ndarray], m: int, min_rows: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(found: pd.DataFrame) -> pd.DataFrame:
        tree, slot = int(found["tree"].iloc[0]), int(found["slot"].iloc[0])
        y, w = (np.concatenate([np.frombuffer(b) for b in found[c]]) for c in ("labels", "weights"))
        x = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, len(l) // 8) for b, l in zip(found["bins"], found["labels"])], axis=1)
        nodes = grow(x, y, w, int(levels[tree][slot]), m, min_rows, np.random.default_rng([seed & 0xFFFFFFFF, tree, slot, 1]))
        return pd.DataFrame({"tree": [tree], "slot": [slot], "nodes": [nodes.tobytes()]})

    return run


# --- forests ------------------------------------------------------------------


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features that a node may be split by, as MLlib counts them."""
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def grow_forest(data: BinnedRows, trees: int, depth: int, min_rows: int, m: int, bootstrap: bool, seed: int) -> list[np.ndarray]:
    """The nodes of each tree."""
    features = len(data.cuts)
    forest = [np.zeros(1, NODE) for _ in range(trees)]
    for nodes in forest:
        nodes["feature"], nodes["gain"], nodes["n"] = -1, -1.0, data.rows
    small: list[list[tuple[int, int]]] = [[] for _ in range(trees)]  # nodes for one task each, with the levels below them
    waiting = [np.zeros(1, int) for _ in range(trees)]

    def asked(nodes: Sequence[tuple[int, int]], level: int) -> _Pass:
        wanted: dict[int, list[int]] = {}
        for tree, node in nodes:
            wanted.setdefault(tree, []).append(node)
        slots = {tree: np.full(len(forest[tree]), -1) for tree in wanted}
        for tree, some in wanted.items():
            slots[tree][some] = np.arange(len(some))
        return _Pass({tree: forest[tree] for tree in wanted}, slots, level, features, seed, bootstrap)

    reached = 0
    for level in range(depth + 1):
        for tree, nodes in enumerate(waiting):
            if depth - level >= LOCAL_LEVELS:
                few = forest[tree]["n"][nodes] <= LOCAL_ROWS
                small[tree] += [(int(node), depth - level) for node in nodes[few]]
                waiting[tree] = nodes[~few]
        here = [(tree, int(node)) for tree, nodes in enumerate(waiting) for node in nodes]
        if not here:
            break
        reached = level + 1
        waiting = [np.zeros(0, int) for _ in range(trees)]
        most = max(1, PASS_CELLS // (m * BINS))
        for a in range(0, len(here), most):
            step = asked(here[a : a + most], level)
            subsets = {
                tree: _subsets(np.random.default_rng([seed & 0xFFFFFFFF, tree, level, a, 0]), int((slot >= 0).sum()), features, m)
                for tree, slot in step.slots.items()
            }
            sums = data.blocks.mapInArrow(_level_sums(step, subsets), "tree int, part int, sums binary")
            best = sums.groupBy("tree", "part").applyInPandas(_level_best(subsets, min_rows), BEST).toPandas()
            for tree, found in best.sort_values("slot").groupby("tree"):
                at = np.flatnonzero(step.slots[tree] >= 0)[found["slot"].to_numpy()]
                values = {c: found[c].to_numpy() for c in found.columns}
                if depth == level:  # a forest without levels
                    values["feature"], values["gain"] = np.full(len(found), -1), np.full(len(found), -1.0)
                nodes = forest[tree]
                split, left, children = _grown(values, len(nodes))
                for k in ("feature", "bin", "gain", "n", "s", "q"):
                    nodes[k][at] = values[k]
                nodes["left"][at] = np.where(split, left, 0)
                if level + 1 < depth:
                    waiting[tree] = np.append(waiting[tree], len(nodes) + np.flatnonzero(_open(children, min_rows)))
                forest[tree] = np.append(nodes, children)

    if any(small):
        levels = {tree: np.array([left for _, left in some]) for tree, some in enumerate(small) if some}
        step = asked([(tree, node) for tree, some in enumerate(small) for node, _ in some], reached)
        # node numbers rise with their level, so slots follow the order of ``small``
        rows = data.blocks.mapInArrow(_small_rows(step), "tree int, slot int, bins binary, labels binary, weights binary")
        groups = sum(map(len, small))
        dealt = min(groups, max(2 * data.blocks.sparkSession.sparkContext.defaultParallelism, data.rows * trees // 2_000_000))
        grown = rows.repartition(dealt, "tree", "slot").groupBy("tree", "slot")
        for tree, slot, blob in grown.applyInPandas(_grow_small(levels, m, min_rows, seed), "tree int, slot int, nodes binary").collect():
            below, nodes = np.frombuffer(blob, NODE).copy(), forest[tree]
            below["left"][below["feature"] >= 0] += len(nodes) - 1
            nodes[small[tree][slot][0]] = below[0]
            forest[tree] = np.append(nodes, below[1:])
    return forest


def _node_table(forest: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> pa.Table:
    """Nodes as MLlib stores them; children come after their parents."""
    nodes = np.concatenate(forest)
    sizes = [len(t) for t in forest]
    split = nodes["feature"] >= 0
    with np.errstate(all="ignore"):
        mean = np.where(nodes["n"] > 0, nodes["s"] / nodes["n"], 0.0)
        spread = np.where(nodes["n"] > 0, np.maximum(nodes["q"] / nodes["n"] - mean**2, 0.0), 0.0)
    left = np.where(split, nodes["left"], -1).astype(np.int32)
    wide = np.full((len(cuts), BINS), np.nan)
    for f, c in enumerate(cuts):
        wide[f, : len(c)] = c
    threes = np.arange(0, 3 * len(nodes) + 1, 3, dtype=np.int32)
    stats = pa.ListArray.from_arrays(threes, np.stack([nodes[k] for k in ("n", "s", "q")], axis=1).ravel())
    at = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(split)]).astype(np.int32), wide[nodes["feature"][split], nodes["bin"][split]])
    kinds = np.full(len(nodes), -1, np.int32)
    cut = pa.StructArray.from_arrays([pa.array(nodes["feature"].astype(np.int32)), at, pa.array(kinds)], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = {
        "id": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]), "prediction": mean, "impurity": spread, "impurityStats": stats,
        "rawCount": nodes["n"].astype(np.int64), "gain": nodes["gain"], "leftChild": left, "rightChild": np.where(split, left + 1, -1).astype(np.int32), "split": cut,
    }
    arrays = [v if isinstance(v, pa.Array) else pa.array(np.ascontiguousarray(v)) for v in data.values()]
    return pa.table({"treeID": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "nodeData": pa.StructArray.from_arrays(arrays, list(data))})


@dataclass(frozen=True)
class Grown:
    """Trees that were grown on binned rows, with their weights in the prediction."""

    trees: Sequence[np.ndarray]
    weights: Sequence[float]
    cuts: tuple[np.ndarray, ...]

    def score(self, blocks: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
        """Labels and predictions of blocks that have the same cuts, without a model of MLlib's."""
        kept = [np.ascontiguousarray(t[["feature", "bin", "left"]]) for t in self.trees]
        values = [w * np.divide(t["s"], t["n"], out=np.zeros(len(t)), where=t["n"] > 0) for t, w in zip(self.trees, self.weights)]
        levels, features = [_levels(t) for t in self.trees], len(self.cuts)

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x, y, _ in _blocks_of(batch, features):
                    rows, total = np.arange(len(y)), np.zeros(len(y))
                    for nodes, value, depth in zip(kept, values, levels):
                        total += value[_walk(nodes, x, rows, depth)]
                    yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(total)], names=[label, prediction])

        return blocks.mapInArrow(step, f"`{label}` double, `{prediction}` double")

    def model(self, spark: SparkSession, regressor: Estimator, kind: type):
        """The trees in MLlib's files, loaded by MLlib."""
        folder = work_folder(spark, "forest")

        def metadata(name: str, uid: str, wanted: Callable[[str], bool]) -> dict:
            given, defaults = ({p.name: v for p, v in m.items() if wanted(p.name)} for m in (regressor._paramMap, regressor._defaultParamMap))
            whole = f"org.apache.spark.ml.regression.{name}"
            return {"class": whole, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": given, "defaultParamMap": defaults}

        count = len(self.trees)
        weights = [float(w / self.weights[0]) for w in self.weights]  # MLlib's forests divide by their number themselves
        top = metadata(kind.__name__, regressor.uid, lambda name: True) | {"numFeatures": len(self.cuts), "numTrees": count}
        each = [(t, json.dumps(metadata("DecisionTreeRegressionModel", f"{regressor.uid}_{t}", TREE_PARAMS.__contains__)), w) for t, w in enumerate(weights)]
        spark.createDataFrame([(json.dumps(top),)], "value string").coalesce(1).write.text(f"{folder}/metadata")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
        table = _node_table(self.trees, self.cuts)
        spark.createDataFrame(table).coalesce(1 + len(table) // 500_000).write.parquet(f"{folder}/data")
        return kind.load(folder)


class HistogramTrees(Estimator):
    """An MLlib regressor of trees, with its parameters, fitted on binned rows."""

    def __init__(self, regressor: Estimator) -> None:
        super().__init__()
        self.regressor = regressor

    def bin(self, dataset: DataFrame) -> BinnedRows:
        return bin_rows(dataset, self.regressor.getLabelCol(), self.regressor.getFeaturesCol())

    def takes(self, dataset: DataFrame) -> bool:
        """Whether a frame of this size is grown here; otherwise the fit is the regressor's own."""
        return True

    def grow(self, data: BinnedRows) -> Grown:
        raise NotImplementedError


class HistogramForest(HistogramTrees):
    def grow(self, data: BinnedRows) -> Grown:
        r: RandomForestRegressor = self.regressor
        trees = r.getNumTrees()
        m = subset_size(r.getFeatureSubsetStrategy(), len(data.cuts), trees)
        forest = grow_forest(data, trees, r.getMaxDepth(), r.getMinInstancesPerNode(), m, r.getBootstrap(), r.getSeed())
        return Grown(forest, [1.0 / trees] * trees, data.cuts)

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        with self.bin(dataset) as data:
            return self.grow(data).model(dataset.sparkSession, self.regressor, RandomForestRegressionModel)


# --- boosting -----------------------------------------------------------------


def boost(x: np.ndarray, y: np.ndarray, rounds: int, rate: float, depth: int, min_rows: int, m: int, share: float, seed: int) -> list[np.ndarray]:
    """Rounds of squared error: a tree on the labels, then one on twice the residuals each, weighed by the rate."""
    rows, at, trees = np.arange(len(y)), np.zeros(len(y)), []
    for r in range(rounds):
        rng = np.random.default_rng([seed & 0xFFFFFFFF, r, 2])
        drawn = rows if share >= 1 else np.flatnonzero(rng.random(len(y)) < share)
        target = 2 * (y - at) if r else y
        nodes = grow(x[:, drawn], target[drawn], np.ones(len(drawn)), depth, m, min_rows, rng)
        with np.errstate(all="ignore"):
            value = np.where(nodes["n"] > 0, nodes["s"] / nodes["n"], 0.0)
        at = at + (rate if r else 1.0) * value[_walk(nodes, x, rows, depth)]
        trees.append(nodes)
    return trees


def _boosted(features: int, *options) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(found: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(found)), key=lambda i: (found["bins"].iloc[i], found["labels"].iloc[i]))  # as tasks may end in any order
        blocks = [(np.frombuffer(found["bins"].iloc[i], np.uint8).reshape(features, -1), np.frombuffer(found["labels"].iloc[i])) for i in order]
        x, y = np.concatenate([b[0] for b in blocks], axis=1), np.concatenate([b[1] for b in blocks])
        trees = boost(x, y, *options)
        return pd.DataFrame({"tree": range(len(trees)), "nodes": [t.tobytes() for t in trees]})

    return run


class HistogramBoosting(HistogramTrees):
    """Models of few rows; larger ones are MLlib's fits."""

    def takes(self, dataset: DataFrame) -> bool:
        return dataset.count() <= BOOST_ROWS

    def grow(self, data: BinnedRows) -> Grown:
        r: GBTRegressor = self.regressor
        features, rounds, rate = len(data.cuts), r.getMaxIter(), r.getStepSize()
        m = subset_size(r.getFeatureSubsetStrategy(), features, 1)
        run = _boosted(features, rounds, rate, r.getMaxDepth(), r.getMinInstancesPerNode(), m, r.getSubsamplingRate(), r.getSeed())
        found = sorted(map(tuple, data.blocks.groupBy().applyInPandas(run, "tree int, nodes binary").collect()))
        return Grown([np.frombuffer(blob, NODE) for _, blob in found], [1.0, *[rate] * (rounds - 1)], data.cuts)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        if not self.takes(dataset):
            return self.regressor.fit(dataset)
        with self.bin(dataset) as data:
            return self.grow(data).model(dataset.sparkSession, self.regressor, GBTRegressionModel)
