"""Embedding near-dedup with a robust-pruned flat graph.

Equal vectors of a label become one class with a count. The classes of each (label, length) are
cut into overlapping cluster shards: pivots are drawn by hash, every class goes to its few nearest pivots,
and a shard that is still too large is cut again by pivots of its own. Each shard builds a flat graph
whose neighbour lists are robustly pruned; lists of one vector from several shards are united. Each
shard then searches every one of its vectors: greedy descent from the shard's medoid, then range
expansion over all nodes near the threshold. Every hit is verified in double precision, and counted in
the first shard that both vectors share. A shard that pivots cannot cut (a third of all rows within the
threshold, say) is dealt as pairs of blocks, so no task holds more than two blocks. A minimum spanning
tree of each shard joins the graph, so no clump is cut off from another, however large it is. The recall of
every label is audited against brute force for a bounded number of queries; labels below the target are
built again with more overlap, and those still below it are compared exactly, block by block.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, link with nothing: n_links 0, component_id their own id, kept. Vectors of different length
never link. A null id keeps null results and links with nothing. Repeated rows with one id count as
vectors each and give a row each. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable
from cartoscope.operators.graph import connected_components

#: Classes of one shard at most (two blocks of half of it where pivots cannot cut), pivots of one cut, cuts.
SHARD, PIVOTS, CUTS = 2000, 128, 3
#: A cut that leaves more than this share of a shard together ends its cutting.
MOST = 0.8
#: Rows of one assignment task, queries of the audit and the recall that they must show.
ASSIGN_ROWS, AUDIT, TARGET = 20_000, 256, 0.95
SLACK = 0.03
#: Rows whose distances to a shard are held at once while lists are built.
ROWS = 128
#: Queries searched together: their frontiers are held at once.
QUERIES = 32


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors, each scaled by the power of two that brings its largest component below 1: exact, and squares neither overflow nor vanish."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    _, exponent = np.frexp(np.abs(x).max(1, initial=0))
    return np.ldexp(x, -exponent[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def robust_lists(x: np.ndarray, degree: int, alpha: float, pool: int = 64) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: the nearest first, without those that a chosen one is alpha times closer to."""
    n = len(x)
    width = min(pool, n - 1)
    out = []
    for start in range(0, n, ROWS):  # distances of a few rows at a time, never of all pairs
        near = 1 - x[start : start + ROWS] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = np.inf
        pools = np.argpartition(near, width - 1, axis=1)[:, :width]
        for row, some in zip(near, pools, strict=True):
            some = some[np.argsort(row[some], kind="stable")]
            between, away = 1 - x[some] @ x[some].T, row[some]
            left, picked = np.arange(len(some)), []
            while len(left) and len(picked) < degree:
                best = left[0]
                picked.append(some[best])
                left = left[1:]
                left = left[alpha * between[best, left] > away[left]]
            out.append(np.array(picked, np.int64))
    return out


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a minimum spanning tree of unit vectors: what hangs together at any threshold does so by its edges."""
    n = len(x)
    best, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    now, ends = 0, []
    for _ in range(n - 1):
        left[now] = False
        near = 1 - x @ x[now]
        closer = left & (near < best)
        best[closer], parent[closer] = near[closer], now
        now = int(np.where(left, best, np.inf).argmin())
        ends.append(now)
    to = np.array(ends, np.int64)
    return parent[to], to


def range_search(x: np.ndarray, lists: np.ndarray, queries: np.ndarray, medoid: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with cosine >= threshold - SLACK that greedy descent and range expansion reach.

    lists: neighbour lists, padded with -1; queries: nodes that are searched.
    """
    current = np.full(len(queries), medoid)
    best = (x[queries] * x[current]).sum(1)
    active = np.arange(len(queries))
    while len(active):
        around = lists[current[active]]
        sims = np.where(around >= 0, np.einsum("qd,qkd->qk", x[queries[active]], x[around]), -2)
        k = sims.argmax(1)
        top = sims[np.arange(len(active)), k]
        better = top > best[active]
        active = active[better]
        current[active], best[active] = around[better, k[better]], top[better]
    seen = np.zeros((len(queries), len(x)), bool)
    q, v = np.r_[np.arange(len(queries)), np.arange(len(queries))], np.r_[current, queries]
    hits_q, hits_v = [], []
    while len(q):
        new = np.unique(q * len(x) + v)
        q, v = new // len(x), new % len(x)
        fresh = ~seen[q, v]
        q, v = q[fresh], v[fresh]
        seen[q, v] = True
        inside = (x[queries[q]] * x[v]).sum(1) >= threshold - SLACK
        q, v = q[inside], v[inside]
        hits_q.append(q)
        hits_v.append(v)
        around = lists[v]
        q, v = np.repeat(q, around.shape[1]), around.ravel()
        q, v = q[v >= 0], v[v >= 0]
    return np.concatenate(hits_q), np.concatenate(hits_v)


def thinned(pivots: np.ndarray, close: float) -> list[int]:
    """Places of the pivots without those that an earlier one is as close to, so that a clump has one pivot and stays together."""
    kept: list[int] = []
    for i, p in enumerate(pivots):
        if not kept or (pivots[kept] @ p).max() < close:
            kept.append(i)
    return kept


def _assign(overlap: int, close: float):
    def run(key: tuple, rows: pa.Table, pivots: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({"rep": pa.array([], pa.int64()), "cell": pa.array([], pa.int64()), "was": pa.array([], pa.int64())})
        x, names = _unit(_matrix(rows["vector"])), pivots["pivot"].to_numpy()
        order = np.argsort(names)
        places = _unit(_matrix(pivots["vector"]))[order]
        kept = thinned(places, close)
        sims = x @ places[kept].T
        m = min(overlap, len(kept))
        top = np.argpartition(-sims, m - 1, axis=1)[:, :m]
        cell = names[order][kept][top].ravel()
        return pa.table({"rep": pa.array(np.repeat(rows["rep"].to_numpy(), m)), "cell": pa.array(cell), "was": pa.array(np.repeat(rows["n"].to_numpy(), m))})

    return lambda key, rows, pivots: run(key, rows, pivots)


def _build(degree: int, alpha: float):
    def run(table: pa.Table) -> pa.Table:
        reps = table["rep"].to_numpy()
        reps, at = np.unique(reps, return_index=True)
        x = _unit(_matrix(table["vector"]))[at]
        lists = robust_lists(x, degree, alpha, max(64, 3 * degree)) if len(reps) > 1 else [np.zeros(0, np.int64)]
        for a, b in zip(*spanning_tree(x), strict=True):
            lists[a] = np.append(lists[a], b)
        return pa.table({"rep": pa.array(reps), "near": pa.array([reps[i] for i in lists], pa.list_(pa.int64()))})

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _search(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        reps, at = np.unique(table["rep"].to_numpy(), return_index=True)
        raw = _matrix(table["vector"])[at]
        x, count = _unit(raw), table["cnt"].to_numpy()[at]
        block = table["block"].to_numpy()[at]
        split = len(np.unique(table["side"].to_numpy())) > 1
        shard = table["shard"][0].as_py()
        homes = [set(h) for h in table["homes"].take(pa.array(at)).to_pylist()]
        edges = [(i, j) for i, near in enumerate(table["near"].take(pa.array(at)).to_pylist()) for j in near]
        a = np.array([e[0] for e in edges], np.int64)
        to = np.array([e[1] for e in edges], np.int64)
        k = np.minimum(np.searchsorted(reps, to), len(reps) - 1)
        a, k = a[reps[k] == to], k[reps[k] == to]
        both = np.unique(np.r_[a * len(reps) + k, k * len(reps) + a])
        a, k = both // len(reps), both % len(reps)
        size = np.bincount(a, minlength=len(reps))
        lists = np.full((len(reps), max(1, size.max(initial=0))), -1)
        lists[a, np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size)] = k
        medoid = int((x @ x.mean(0)).argmax())
        pairs_q, pairs_v = [], []
        for i in range(0, len(reps), QUERIES):
            q, v = range_search(x, lists, np.arange(i, min(i + QUERIES, len(reps))), medoid, threshold)
            pairs_q.append(q + i)
            pairs_v.append(v)
        q, v = np.concatenate(pairs_q), np.concatenate(pairs_v)
        ok = (q < v) & ((x[q] * x[v]).sum(1) >= threshold - 1e-9)
        q, v = q[ok], v[ok]
        ok = (raw[q] * raw[v]).sum(1) / (np.sqrt((raw[q] * raw[q]).sum(1)) * np.sqrt((raw[v] * raw[v]).sum(1))) >= threshold
        q, v = q[ok], v[ok]
        if split:  # of two blocks only pairs across count here
            ok = block[q] != block[v]
            q, v = q[ok], v[ok]
        own = np.array([min(homes[i] & homes[j]) == shard for i, j in zip(q.tolist(), v.tolist(), strict=True)], bool)
        q, v = q[own], v[own]
        links = np.zeros(len(reps), np.int64)
        np.add.at(links, q, count[v])
        np.add.at(links, v, count[q])
        return pa.table({"rep": pa.array(reps), "links": pa.array(links), "root": pa.array(reps[_roots(len(reps), q, v)])})

    return run


def _compare(threshold: float):
    """Links of one block, or across two, by comparing all pairs."""

    def run(table: pa.Table) -> pa.Table:
        reps, at = np.unique(table["rep"].to_numpy(), return_index=True)
        raw, count, block = _matrix(table["vector"])[at], table["cnt"].to_numpy()[at], table["block"].to_numpy()[at]
        split = table["lo"][0].as_py() != table["hi"][0].as_py()
        x, norm = _unit(raw), np.sqrt((raw * raw).sum(1))
        links, root = np.zeros(len(reps), np.int64), np.arange(len(reps))
        for i in range(0, len(reps), QUERIES):
            q, v = np.nonzero(x[i : i + QUERIES] @ x.T >= threshold - 1e-9)
            q = q + i
            ok = (q < v) & (block[q] != block[v]) if split else q < v
            q, v = q[ok], v[ok]
            ok = (raw[q] * raw[v]).sum(1) / (norm[q] * norm[v]) >= threshold
            q, v = q[ok], v[ok]
            np.add.at(links, q, count[v])
            np.add.at(links, v, count[q])
            root = root[_roots(len(reps), np.r_[np.arange(len(reps)), q], np.r_[root, v])]
        return pa.table({"rep": pa.array(reps), "links": pa.array(links), "root": pa.array(reps[root])})

    return run


def _exact(classes: DataFrame, threshold: float) -> DataFrame:
    """Rows (rep, links, root) of all pairs of each label, dealt as pairs of blocks."""
    placed = _blocks(classes.select("rep", F.col("label_key").alias("shard")))
    placed = placed.join(classes.select("rep", "vector", "cnt"), "rep")
    return placed.groupBy("shard", "lo", "hi").applyInArrow(_compare(threshold), "rep long, links long, root long")


def _blocks(shards: DataFrame) -> DataFrame:
    """Rows (rep, shard, block, lo, hi): shards over SHARD are dealt as all pairs of blocks of half of it."""
    sizes = shards.groupBy("shard").agg(F.count("*").alias("n"))
    blocks = F.when(F.col("n") > SHARD, F.ceil(F.col("n") * 2 / SHARD)).otherwise(1)
    placed = shards.join(sizes, "shard").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep", F.lit("block")), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    placed = placed.select("rep", "shard", "block", other)
    return placed.select("rep", "shard", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def _shards(classes: DataFrame, overlap: int, close: float) -> DataFrame:
    """Rows (rep, shard): every class in its overlapping shards. A shard over SHARD is left as it is after CUTS cuts, or
    where a cut kept most of it together: a clump that pivots cannot cut."""
    rows = classes.select("rep", F.xxhash64("label", F.size("vector")).alias("shard"), F.lit(1 << 60).alias("was"))
    done = None
    for cut in range(CUTS + 1):
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))
        rows = durable(rows.join(sizes, "shard"), "shards")
        final = F.lit(cut == CUTS) | (F.col("n") <= SHARD) | (F.col("n") > MOST * F.col("was"))
        small = rows.where(final).select("rep", "shard")
        done = small if done is None else done.unionByName(small)
        rows = rows.where(~final)
        if cut == CUTS or rows.isEmpty():
            return durable(done.distinct(), "shards")
        rows = rows.join(classes.select("rep", "vector"), "rep").withColumn("parts", F.ceil(F.col("n") / ASSIGN_ROWS))
        rows = rows.withColumn("part", F.pmod(F.xxhash64("rep", F.lit("part")), "parts"))
        wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("n") * 3.0 * overlap / SHARD))
        draw = F.pmod(F.xxhash64("rep", "shard", F.lit(cut)), F.col("n")) < wanted
        # the class of the smallest hash makes one pivot sure
        pivots = rows.where(draw).select("shard", "rep", "vector", "parts")
        first = rows.groupBy("shard").agg(F.min_by(F.struct("rep", "vector", "parts"), F.xxhash64("rep", F.lit(cut))).alias("p")).select("shard", "p.*")
        pivots = pivots.unionByName(first).dropDuplicates(["shard", "rep"])
        pivots = pivots.select("shard", F.xxhash64("shard", "rep", F.lit(cut)).alias("pivot"), "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        pivots, dealt = durable(pivots, "pivots"), rows.select("shard", "part", "rep", "vector", "n")  # read back, so the two sides share no columns
        together = dealt.groupBy("shard", "part").cogroup(pivots.groupBy("shard", "part"))
        rows = together.applyInArrow(_assign(overlap, close), "rep long, cell long, was long").select("rep", F.col("cell").alias("shard"), "was")
    return done


def _linked(classes: DataFrame, threshold: float, overlap: int, degree: int, alpha: float) -> DataFrame:
    """Rows (rep, links, root) of one build and search, one row for each group that a class was in."""
    shards = _shards(classes, overlap, threshold - SLACK)
    homes = shards.groupBy("rep").agg(F.collect_list("shard").alias("homes"))
    placed = _blocks(shards)
    placed = placed.join(classes.select("rep", "vector", "cnt"), "rep").join(homes, "rep")
    placed = durable(placed, "placed")
    graph = placed.select("shard", "lo", "hi", "rep", "vector").groupBy("shard", "lo", "hi").applyInArrow(_build(degree, alpha), "rep long, near array<long>")
    union = graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    sided = placed.withColumn("side", F.when(F.col("lo") == F.col("hi"), 0).otherwise(F.when(F.col("block") == F.col("lo"), 1).otherwise(2)))
    return sided.join(union, "rep").groupBy("shard", "lo", "hi").applyInArrow(_search(threshold), "rep long, links long, root long")


def _brute(threshold: float):
    """Verified links of the audit's queries within one part of their label."""

    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        links = np.zeros(len(queries), np.int64)
        if len(rows) and len(queries):
            rep, count, asked = rows["rep"].to_numpy(), rows["cnt"].to_numpy(), queries["query"].to_numpy()
            sims = _unit(_matrix(queries["vector"])) @ _unit(_matrix(rows["vector"])).T
            links = ((sims >= threshold) & (rep[None, :] != asked[:, None])) @ count
        return pa.table({"rep": queries["query"], "links": pa.array(links.astype(np.int64))})

    return lambda key, rows, queries: run(key, rows, queries)


def audit_recall(classes: DataFrame, found: DataFrame, threshold: float, queries: int = AUDIT) -> DataFrame:
    """Rows (label_key, recall): the share of the true links of about so many classes of each label, drawn by a hash, that found (rep, links) has."""
    sizes = classes.groupBy("label_key").agg(F.count("*").alias("n"))
    rows = classes.select("rep", "label_key", "vector", "cnt").join(sizes, "label_key").withColumn("parts", F.ceil(F.col("n") / ASSIGN_ROWS))
    some = rows.where(F.pmod(F.xxhash64("rep", F.lit("audit")), F.col("n")) < queries)
    some = some.select("label_key", F.col("rep").alias("query"), "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    some = durable(some, "audit")  # read back, so the two sides share no columns
    dealt = rows.select("label_key", F.pmod(F.xxhash64("rep", F.lit("part")), "parts").alias("part"), "rep", "vector", "cnt")
    truth = dealt.groupBy("label_key", "part").cogroup(some.groupBy("label_key", "part")).applyInArrow(_brute(threshold), "rep long, links long")
    truth = truth.groupBy("rep").agg(F.sum("links").alias("truth")).join(classes.select("rep", "label_key"), "rep").join(found, "rep", "left")
    sums = truth.groupBy("label_key").agg(F.sum("truth").alias("truth"), F.sum(F.least("truth", F.coalesce("links", F.lit(0)))).alias("met"))
    return sums.select("label_key", F.when(F.col("truth") > 0, F.col("met") / F.col("truth")).otherwise(1.0).alias("recall"))


def near_duplicates(embeddings: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, overlap: int = 3, degree: int = 24, alpha: float = 1.2) -> DataFrame:
    """Rows (id_col, n_links, component_id, kept): links are pairs of one label with cosine >= threshold."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("ok", F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False)))
    keyed = rows.select("id", "ok", F.when(F.col("ok"), F.struct("label", "vector")).alias("key"))
    classes = keyed.where("ok").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("cnt"))
    # two classes can share their smallest id only if rows share an id; their vectors then stand for one node
    classes = classes.select("rep", "key.label", "key.vector", "cnt", "key").withColumn("label_key", F.xxhash64("label", F.size("vector")))
    classes = durable(classes, "classes")
    raw, left = None, classes
    for _ in range(3):
        now = durable(_linked(left, threshold, overlap, degree, alpha), "linked")
        recall = audit_recall(left, now.groupBy("rep").agg(F.sum("links").alias("links")), threshold)
        low = durable(recall.where(F.col("recall") < TARGET).select("label_key"), "low")
        if low.isEmpty():
            raw, left = now if raw is None else raw.unionByName(now), None
            break
        good = left.join(low, "label_key", "left_anti").select("rep")
        good = now.join(good, "rep", "left_semi")
        raw = good if raw is None else raw.unionByName(good)
        left = durable(left.join(low, "label_key", "left_semi"), "left")
        overlap, degree = overlap + 3, 2 * degree
    if left is not None:
        raw = raw.unionByName(durable(_exact(left, threshold), "exact"))
    found = raw.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = connected_components(raw.where("rep <> root"), "rep", "root").withColumnRenamed("node", "rep")
    named = classes.join(found, "rep", "left").join(comps, "rep", "left")
    named = named.select("key", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = keyed.join(named, "key", "left")
    out = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
