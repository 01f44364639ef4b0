"""Ensembles of boosted trees: all models grow together, one aggregate a tree level.

Features are put into quantile bins once. A level's aggregate sums gradients and curvatures by (model, node, feature,
bin) for all models at once: each task adds up the cells of its rows, the cells are summed by a shuffle, and the
splits are chosen from these sums, whose number follows from the parameters and not from the rows. Sums are whole
numbers (gradients in units of 1 / UNIT), so a tree does not depend on the order or the partitions of the rows. What the
trees so far give for a row is kept beside its bins and brought up to date every REFRESH rounds. A row of this table is a block of
rows, so only bytes are moved to Python, and a tree compares whole columns of bin numbers.

Training goes on from the trees of an earlier ensemble (start), which are rows of a table like any others.

Defined results: a null or NaN feature is missing and goes the way of the split that gains most; rows with a null label teach
nothing. An empty table, or a model without rows, has trees of one leaf of value 0.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release
from cartoscope.operators.detect import threshold_class

#: Whole numbers stand for gradients in these units; a sum of 2^43 rows still fits.
UNIT = 1 << 20
#: Rounds after which each row's margins are written anew.
REFRESH = 3
#: Rows that go through the trees at once: many enough that the calls of a tree cost little beside them.
STRIDE = 1 << 16
#: Cells (model, node, feature, bin) of a level that are summed at once; more models than fit are trained one part behind the other.
CELLS = 4_000_000
#: Regularisation of leaf values, least curvature of a child, least gain of a split.
LAMBDA, LEAST_CURVATURE, LEAST_GAIN = 1.0, 1.0, 1e-6


@dataclass(frozen=True)
class Ensemble:
    """Trees of all models: arrays (round, model, node); node 0 is the root, the children of i are 2 i + 1 and 2 i + 2.

    feature: -1 in a leaf. Rows with a value below cut, or without one where missing_left is true, go left. edges: cuts that features may have.
    """

    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    def models(self, some: slice) -> Ensemble:
        return replace(self, **{k: getattr(self, k)[:, some] for k in ("feature", "cut", "missing_left", "value")})

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The bin (feature, row) of each value: the number of edges not above it, and one more than the most edges where it is missing."""
        none = max([len(e) for e in self.edges], default=0) + 1
        kind = np.min_scalar_type(none)
        columns = np.ascontiguousarray(x.T)
        return np.array([np.where(np.isnan(c), none, np.searchsorted(e, c, "right")).astype(kind) for c, e in zip(columns, self.edges, strict=True)], kind).reshape(columns.shape)

    def margins(self, x: np.ndarray, first: int = 0) -> np.ndarray:
        """Sum of the leaf values (row, model) of the rounds from first on; x: (row, feature), NaN where missing."""
        out = np.zeros((self.feature.shape[1], len(x)))
        for a in range(0, len(x), STRIDE):
            self.add(self.codes(x[a : a + STRIDE]), out[:, a : a + STRIDE], first)
        return out.T

    def add(self, codes: np.ndarray, out: np.ndarray, first: int = 0, last: int | None = None) -> None:
        """Add the leaf values of the rounds from first to last to out (model, row)."""
        for r in range(first, len(self.feature) if last is None else last):
            for m, node in enumerate(self.leaves(codes, r)):
                out[m] += self.value[r, m].take(node)

    def leaves(self, codes: np.ndarray, r: int) -> Iterator[np.ndarray | int]:
        """The node of each row (or one of all) in each model's tree of a round: every split is one comparison of a whole column."""
        none = max([len(e) for e in self.edges], default=0) + 1
        holes = (codes == none).any(1)
        kind = np.min_scalar_type(self.feature.shape[2])
        feature, cut, missing_left = (v[r] for v in (self.feature, self.cut, self.missing_left))

        def under(m: int, i: int) -> np.ndarray | int:
            f = feature[m, i]
            if f < 0:
                return i
            # a value is below its cut where its bin is at most the cut's
            left = codes[f] <= codes.dtype.type(bisect_left(self.edges[f], cut[m, i]))
            if holes[f] and missing_left[m, i]:
                left |= codes[f] == none
            every = np.negative(left.view(np.uint8)) if kind == np.uint8 else np.negative(left.astype(kind))  # all bits or none
            a, b = (v if isinstance(v, np.ndarray) else kind.type(v) for v in (under(m, 2 * i + 1), under(m, 2 * i + 2)))
            return b ^ ((a ^ b) & every)

        for m in range(self.feature.shape[1]):
            yield under(m, 0)


def empty(features: Sequence[str], edges: Sequence[np.ndarray], models: int, depth: int, rounds: int = 0) -> Ensemble:
    shape = (rounds, models, (2 << depth) - 1)
    return Ensemble(tuple(features), tuple(edges), np.full(shape, -1, np.int32), np.full(shape, np.nan), np.zeros(shape, bool), np.zeros(shape))


def to_table(trees: Ensemble) -> DataFrame:
    """Rows (model, round, node, feature, cut, missing_left, value) of all nodes that a tree has, and (feature, cut) of the edges with a null model."""
    kept = np.zeros(trees.feature.shape, bool)
    kept[..., :1] = True
    for i in range(trees.feature.shape[2] // 2):
        kept[..., 2 * i + 1] = kept[..., 2 * i + 2] = kept[..., i] & (trees.feature[..., i] >= 0)
    r, m, n = np.nonzero(kept)
    f = trees.feature[kept]
    names = np.array([*trees.features, None], object)[f]
    nodes = pa.table({"model": pa.array(m, pa.int32()), "round": pa.array(r, pa.int32()), "node": pa.array(n, pa.int32()), "feature": pa.array(names, pa.string()), "cut": pa.array(trees.cut[kept], mask=f < 0), "missing_left": pa.array(trees.missing_left[kept], mask=f < 0), "value": pa.array(trees.value[kept], mask=f >= 0)})
    size = pa.table({"node": pa.array([trees.feature.shape[2]], pa.int32()), "model": pa.array([trees.feature.shape[1]], pa.int32()), "round": pa.array([-1], pa.int32())})
    edges = [pa.table({"feature": pa.array([n] * len(e), pa.string()), "cut": pa.array(e)}) for n, e in zip(trees.features, trees.edges, strict=True)]
    order = [pa.table({"feature": pa.array([n], pa.string()), "node": pa.array([i], pa.int32()), "round": pa.array([-2], pa.int32())}) for i, n in enumerate(trees.features)]
    return SparkSession.active().createDataFrame(pa.concat_tables([nodes, size, *edges, *order], promote_options="default"))


def from_table(table: DataFrame) -> Ensemble:
    """The ensemble of a table of to_table(), whose rows are as many as its trees have nodes."""
    t = table.toArrow().to_pandas()
    size = t[t["round"] == -1].iloc[0]
    order = t[t["round"] == -2].sort_values("node")
    names = order["feature"].tolist()
    edges = [np.sort(t[t["round"].isna() & (t["feature"] == n)]["cut"].to_numpy(np.float64)) for n in names]
    nodes = t[t["round"] >= 0]
    depth = (int(size["node"]) + 1).bit_length() - 2
    out = empty(names, edges, int(size["model"]), depth, int(nodes["round"].max()) + 1 if len(nodes) else 0)
    at = tuple(nodes[c].to_numpy(np.int64) for c in ("round", "model", "node"))
    leaf = nodes["feature"].isna().to_numpy()
    out.feature[at] = np.where(leaf, -1, nodes["feature"].map({n: i for i, n in enumerate(names)}).fillna(-1).to_numpy(np.int64))
    out.cut[at] = nodes["cut"].to_numpy(np.float64)
    out.missing_left[at] = nodes["missing_left"].fillna(False).to_numpy(bool)
    out.value[at] = nodes["value"].fillna(0.0).to_numpy(np.float64)
    return out


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """For each feature at most bins - 1 values that part its rows into bins of about the same size."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = rows.agg(*[F.percentile_approx(value(c), at, 100_000).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(features))]


#: Rows of a block, so that the some thousand blocks that Spark reads at once are small.
BLOCK = 64
#: Blocks of rows: bins (feature, row), labels, which models learn from a row (model, bits of rows), margins (model, row). No model learns from the rows that fill the last block.
STATE = "codes binary, y binary, learns binary, margins binary"


def _state(codes: np.ndarray, y: np.ndarray, learns: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    """Arrays (..., row) of whole blocks as rows of STATE."""
    n, out = len(y) // BLOCK, []
    for v in (codes, y[None], learns, margins):
        held = np.ascontiguousarray(v.reshape(len(v), n, -1).transpose(1, 0, 2))
        ends = np.arange(n + 1, dtype=np.int32) * (held.nbytes // n if n else 0)
        out.append(pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(held)]))
    return pa.RecordBatch.from_arrays(out, ["codes", "y", "learns", "margins"])


def _columns(column: pa.Array, kind: np.dtype | type, height: int) -> np.ndarray:
    """(height, row) of blocks of one size."""
    _, ends, held = column.buffers()
    first, last = (int(np.frombuffer(ends, np.int32)[column.offset + i]) for i in (0, len(column)))
    return np.frombuffer(held, np.uint8)[first:last].view(kind).reshape(len(column), height, -1).transpose(1, 0, 2).reshape(height, -1)


def _blocks(batches: Iterator[pa.RecordBatch], trees: Ensemble) -> Iterator[tuple[np.ndarray, ...]]:
    """codes, y, learns (bits) and margins (to be written to) of some blocks at a time."""
    features, models = len(trees.features), trees.feature.shape[1]
    kind, step = np.min_scalar_type(max([len(e) for e in trees.edges], default=0) + 1), STRIDE // BLOCK
    for batch in batches:
        for a in range(0, len(batch), step):
            part = batch.slice(a, step)
            yield (_columns(part.column(0), kind, features) if features else np.zeros((0, len(part) * BLOCK), kind)), _columns(part.column(1), np.float64, 1)[0], _columns(part.column(2), np.uint8, models), np.array(_columns(part.column(3), np.float64, models))


def _begun(features: int, trees: Ensemble):
    """Rows (features..., label, learns...) to STATE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), STRIDE):
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.slice(a, STRIDE).columns]
                n = len(columns[features])
                full = lambda v, n=n: np.pad(v, [(0, 0)] * (v.ndim - 1) + [(0, -n % BLOCK)])
                x = np.array([np.asarray(c, float) for c in columns[:features]]).reshape(features, n).T
                learns = np.packbits(full(np.array(columns[features + 1 :]).astype(bool)), axis=1)
                yield _state(full(trees.codes(x)), full(columns[features]), learns, full(trees.margins(x).T))

    return run


def _refreshed(trees: Ensemble, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, y, learns, f in _blocks(batches, trees):
            trees.add(codes, f, first)
            yield _state(codes, y, learns, f)

    return run


def _slopes(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss in whole units, as doubles."""
    p = 1 / (1 + np.exp(-margins))
    return np.rint((p - y) * UNIT), np.rint(p * (1 - p) * UNIT)


def gradients(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss (row, model) in whole units."""
    g, h = _slopes(margins, y[:, None])
    return g.astype(np.int64), h.astype(np.int64)


def _cells(trees: Ensemble, first: int, level: int, bins: int):
    """STATE to sums (cell, g, h) of a level of the trees of the last round; their earlier levels are known."""
    features, models = len(trees.features), trees.feature.shape[1]
    nodes, last = 1 << level, len(trees.feature) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, models, features, nodes * bins))  # exact: whole numbers of less than 2^33 rows
        for codes, y, learns, f in _blocks(batches, trees):
            trees.add(codes, f, first, last)
            places = codes.astype(np.intp)
            used = np.unpackbits(learns, axis=1).astype(bool)
            for m, leaf in enumerate(trees.leaves(codes, last)):
                g, h = _slopes(f[m], y)
                some = used[m]
                if level:
                    node = np.broadcast_to(leaf, y.shape).astype(np.intp) - (nodes - 1)
                    some = some & (node >= 0)  # a smaller node is a leaf of an earlier level
                    head = np.maximum(node, 0) * bins
                g *= some
                h *= some
                for j, place in enumerate(places):
                    at = head + place if level else place
                    sums[0, m, j] += np.bincount(at, g, nodes * bins)
                    sums[1, m, j] += np.bincount(at, h, nodes * bins)
        sums = sums.reshape(2, models, features, nodes, bins).transpose(0, 1, 3, 2, 4).reshape(2, -1).astype(np.int64)
        some = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], ["cell", "g", "h"])

    return run


def best_splits(sums: np.ndarray, edges: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """Of sums (2, node, feature, bin; the last bin is of missing values) the best split of each node: gain, feature, place, left (whether
    missing goes left), and g and h of its children. The first of equal gains is taken: by feature, cut, and missing to the right."""
    g, h = sums / UNIT
    total = [v.sum(2)[:, :1] for v in (g, h)]
    score = lambda a, b: a * a / (b + LAMBDA)
    under = [np.cumsum(v[:, :, :-2], 2) for v in (g, h)]  # below each cut
    lefts = [np.stack([u, u + v[:, :, -1:]], 3) for u, v in zip(under, (g, h), strict=True)]
    rights = [t[:, :, None, None] - v for t, v in zip(total, lefts, strict=True)]
    gain = score(*lefts) + score(*rights) - score(*total)[:, :, None, None]
    allowed = np.arange(gain.shape[2])[None, :] < np.array([len(e) for e in edges])[:, None]
    gain[(lefts[1] < LEAST_CURVATURE) | (rights[1] < LEAST_CURVATURE) | ~allowed[None, :, :, None]] = -np.inf
    flat = gain.reshape(len(gain), -1)
    # gains that differ by rounding alone are equal
    near = flat >= flat.max(1, keepdims=True) - 1e-9 * np.maximum(1, np.abs(flat.max(1, keepdims=True))) if flat.size else flat
    at = np.argmax(near, 1) if flat.size else np.zeros(len(gain), np.int64)
    f, place, side = np.unravel_index(at, gain.shape[1:]) if flat.size else (at, at, at)
    node = np.arange(len(gain))
    picked = [v[node, f, place, side] if flat.size else np.zeros(len(gain)) for v in (*lefts, *rights)]
    return {"gain": flat[node, at] if flat.size else np.full(len(gain), -np.inf), "feature": f, "place": place, "left": side.astype(bool), "gh": np.array(picked)}


def _grown(trees: Ensemble, level: int, sums: np.ndarray, eta: float) -> None:
    """Give the nodes of a level of the last round their splits, and their children leaf values."""
    models, nodes = trees.feature.shape[1], 1 << level
    best = best_splits(sums, trees.edges)
    splits = best["gain"] > LEAST_GAIN
    if level == 0:
        g, h = (sums / UNIT).sum(3)[:, :, 0] if sums.shape[2] else np.zeros((2, models))
        trees.value[-1, :, 0] = -eta * g / (h + LAMBDA)
    for i in np.flatnonzero(splits):
        model, node = i // nodes, i % nodes + nodes - 1
        trees.feature[-1, model, node] = best["feature"][i]
        trees.cut[-1, model, node] = trees.edges[best["feature"][i]][best["place"][i]]
        trees.missing_left[-1, model, node] = best["left"][i]
        trees.value[-1, model, node] = 0.0
        for child in (0, 1):
            g, h = best["gh"][2 * child : 2 * child + 2, i]
            trees.value[-1, model, 2 * node + 1 + child] = -eta * g / (h + LAMBDA)


def _rounds(state: DataFrame, trees: Ensemble, depth: int, rounds: int, eta: float) -> Ensemble:
    """trees with further rounds; state is released."""
    features, models = len(trees.features), trees.feature.shape[1]
    bins = max([len(e) for e in trees.edges], default=0) + 2
    first = len(trees.feature)  # rounds whose values are in the margins
    for r in range(rounds):
        more = empty(trees.features, trees.edges, models, depth, 1)
        trees = replace(trees, **{k: np.concatenate([getattr(trees, k), getattr(more, k)]) for k in ("feature", "cut", "missing_left", "value")})
        for level in range(depth):
            cells = state.mapInArrow(_cells(trees, first, level, bins), "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
            sums = np.zeros((2, models * (1 << level) * features * bins), np.int64)
            sums[:, cells["cell"].to_numpy()] = [cells["g"].to_numpy(), cells["h"].to_numpy()]
            _grown(trees, level, sums.reshape(2, models << level, features, bins), eta)
        if (r + 1) % REFRESH == 0 and r + 1 < rounds:
            now = durable(state.mapInArrow(_refreshed(trees, first), STATE), "state")
            release(state)
            state, first = now, len(trees.feature)
    release(state)
    return trees


def train(rows: DataFrame, features: Sequence[str], label: str, key: str, models: int = 30, depth: int = 3, rounds: int = 50, percent: int = 80, bins: int = 64, eta: float = 0.3, start: Ensemble | None = None) -> Ensemble:
    """Models that differ in the hash split of the rows they learn from (percent of the keys). start: trees to go on from."""
    known = rows.where(F.col(label).isNotNull())
    edges = start.edges if start else quantile_edges(known, features, bins)
    trees = start or empty(features, edges, models, depth)
    if start and (start.features != tuple(features) or start.feature.shape[1] != models or start.feature.shape[2] != (2 << depth) - 1):
        raise ValueError("start has other features, models or depth")
    most = max(1, CELLS // max(1, (1 << (depth - 1)) * len(features) * (max([len(e) for e in edges], default=0) + 2)))
    parts = []
    for a in range(0, models, most):
        b = min(models, a + most)
        learns = [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(100)) < percent for i in range(a, b)]
        table = known.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"), *[v.alias(f"l{i}") for i, v in enumerate(learns)])
        some = trees.models(slice(a, b))
        # a small file is one row group, which is one task: rows are dealt to as many tasks as can run
        table = table.repartition(max(known.sparkSession.sparkContext.defaultParallelism, known.rdd.getNumPartitions()))
        state = durable(table.mapInArrow(_begun(len(features), some), STATE), "state")
        parts.append(_rounds(state, some, depth, rounds, eta))
    return replace(parts[0], **{k: np.concatenate([getattr(p, k) for p in parts], 1) for k in ("feature", "cut", "missing_left", "value")})


def _scored(trees: Ensemble, names: Sequence[str]):
    """Rows (columns..., x: array of features) to (columns..., mean, std)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(trees.features))
            m = trees.margins(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(m.mean(1)), pa.array(m.std(1))], [*names, "mean_score", "std_score"])

    return run


def score(rows: DataFrame, features: Sequence[str], trees: Ensemble) -> DataFrame:
    """rows with the mean and population std of the models' margins, and the class of the mean."""
    kept = [c for c in rows.columns if c not in ("mean_score", "std_score", "predictions")]
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    asked = rows.select(*[F.col(f"`{c}`") for c in kept], x.alias("__x"))
    kinds = ", ".join([*(f"`{c}` {asked.schema[c].dataType.simpleString()}" for c in kept), "mean_score double", "std_score double"])
    return asked.mapInArrow(_scored(trees, kept), kinds).withColumn("predictions", threshold_class(F.col("mean_score")))


def describe(trees: Ensemble) -> DataFrame:
    """One row a model: number of trees and of their nodes."""
    n = 1 + 2 * (trees.feature >= 0).sum((0, 2)) + len(trees.feature) - 1  # each tree has a root, each split two more nodes
    rows = [(i, len(trees.feature), int(k)) for i, k in enumerate(n)]
    return SparkSession.active().createDataFrame(rows, "model int, n_trees int, n_nodes int")
