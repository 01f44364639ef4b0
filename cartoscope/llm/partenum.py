"""N-gram Jaccard join by PartEnum signatures.

Each document is the set of its distinct word shingles. Set sizes are cut into bands whose upper
end is at most lower/threshold, so two similar sets lie in the same or in neighbouring bands. In an
instance (a band and the one below it) similar sets differ in at most k shingles. The shingle
domain is split into first-level partitions, each of them into three second-level ones, and every
subset of two of these is enumerated: k differences leave a first-level partition with at most one,
and there one subset is equal in both sets. The hash of a subset's shingles is a signature. A subset
that is empty in a set tells nothing, so some first-level partitions are spare, and sets with more
empty ones than that also sign under another seed, until no pair can depend on an empty subset; no
candidate is lost and none is capped.

Shingles are compared by 64-bit hashes under a key that is drawn for the run, whole sets of equal size by 128 bits
under two such keys, so no texts can be made in advance that collide. Documents that share a signature are compared by all
their shingles, the likely pairs first: each document with
that smallest id which it meets under most signatures, then with those smallest ids that
are in other components. Documents whose signatures still hold several components are peeled: a
shingle that no other open document has is a difference to each of them, so a document with too many
of these, even beside the one that has fewest, is settled without a comparison. What is left is
joined on the rarest shingles of each set, of which similar sets share one.

Defined results: null and empty texts and texts without words have the empty set, n_shingles 0,
and are linked with nothing (component_id is their own id). Rows with a null id keep a null
component and link nothing. Repeated rows each give a row. An id with several texts is one node, which
links by each of its sets. Texts of any length are used whole. Extra columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release
from cartoscope.llm.text_hash import Texts, U, chunks, draw_keys, mix
from cartoscope.operators.graph import connected_components

#: Ids or pairs that may be broadcast to pick texts (8 or 16 bytes each); beyond it they are shuffled.
BROADCAST_IDS = 500_000
#: Rounds in which documents that differ too much from all other open ones are taken out.
PEELS = 2
#: One shingle in so many shows in the first of these rounds what a document has alone; fewer found alone settle fewer, and lose no pair.
FIRST_PEEL = 4
#: Longs of the shortest sketch of a set.
LEAST_LONGS = 4
#: Longs of parity bits that a document carries into the comparison of pairs (a power of two).
PARITIES = 8
#: A bound that no set of shingles reaches.
FREE = 1 << 40


class Shingles(NamedTuple):
    """Words of a shingle, and the keys of the run's two hashes."""

    q: int
    keys: tuple[int, int]


def shingle_sets(texts: Texts, q: int, second: bool = False) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer than q words the whole sequence is one shingle."""
    h = texts.second if second else texts.hash
    full = np.zeros(max(0, len(h) - q + 1), U)
    for k in range(q):
        full += mix(h[k : len(h) - q + 1 + k] + U(k + 1))
    full = mix(full)
    for a, b in zip(texts.at[:-1], texts.at[1:], strict=True):
        if b - a >= q:
            s = np.sort(full[a : b - q + 1])
            yield s[np.r_[True, s[1:] != s[:-1]]]
        elif b > a:
            few = h[a:b]
            yield mix(np.array([np.sum(mix(few + np.arange(1, b - a + 1, dtype=U)), dtype=U) + U(b - a)], U))
        else:
            yield full[:0]


def bands(percent: int, largest: int) -> list[int]:
    """Lower ends of the size bands, up to one beyond largest."""
    low = [1]
    while low[-1] <= largest:
        low.append(low[-1] * 100 // percent + 1)
    return low


def scheme(instance: int, percent: int, low: list[int]) -> tuple[int, int, int]:
    """Distance k of an instance, its first-level partitions, and how many of these are spare."""
    upper = low[instance] * 100 // percent
    k = 2 * upper * (100 - percent) // (100 + percent)
    n1 = k // 2 + 1
    empty = 3 * n1 * np.exp(-2 * low[max(0, instance - 1)] / (3 * n1))
    spare = int(np.ceil(1.3 * empty + 2.5 * np.sqrt(empty))) if k > 7 else 0
    return k, n1 + spare, spare


def signatures(values: np.ndarray, sizes: np.ndarray, percent: int, low: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of sets (values: their elements one set behind the other) and the set of each:
    for the instance of its own band and the next. Sets that only equal sets are similar to have none."""
    found, owners = [], []
    head = np.cumsum(sizes) - sizes
    band = np.searchsorted(low, sizes, "right") - 1
    for step in (0, 1):
        instances, back = np.unique(band[sizes > 0] + step, return_inverse=True)
        k, n1, spare = np.zeros((3, len(sizes)), np.int64)
        k[sizes > 0], n1[sizes > 0], spare[sizes > 0] = np.array([scheme(int(i), percent, low) for i in instances]).reshape(-1, 3)[back].T
        left, seed = np.flatnonzero(k > 0), 0
        while len(left):
            size = sizes[left]
            of = np.repeat(np.arange(len(left)), size)
            m = mix(values[np.arange(len(of)) + (head[left] - (np.cumsum(size) - size))[of]] ^ mix(np.array([seed], U)))
            cells = 3 * n1[left]
            base = np.cumsum(cells) - cells
            cell = base[of] + ((m >> U(33)) % cells[of].astype(U)).astype(np.int64)
            total = np.zeros(cells.sum(), U)
            np.add.at(total, cell, mix(m))
            count = np.bincount(cell, minlength=len(total)).reshape(-1, 3)
            total = total.reshape(-1, 3)
            pair = total.sum(1, dtype=U)[:, None] - total  # the subset that leaves one of three out
            empty = count.sum(1)[:, None] == count
            owner = np.repeat(np.arange(len(left)), cells)
            place = (np.arange(len(owner)) - base[owner]).astype(U)
            tag = (band[left][owner] + step).astype(U) * U(1_000_003) + U(seed * 7_919 + 1)
            use = ~empty.ravel()
            found.append(mix(mix(pair.ravel()[use] + mix(place[use] + U(1))) ^ tag[use]))
            owners.append(left[owner[use]])
            lacking = np.add.reduceat(empty.any(1), base // 3, dtype=np.int64)
            left, seed = left[lacking > spare[left]], seed + 1
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, U), np.zeros(0, np.int64))


def _flat(texts: Texts, q: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts, one set behind the other, and the sizes of the sets."""
    sets = list(shingle_sets(texts, q, second))
    return np.concatenate(sets), np.array([len(s) for s in sets], np.int64)


def _keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each set: two sums of scrambled elements."""
    sums = np.zeros((2, len(values) + 1), U)
    np.cumsum(mix(values + U(11)), out=sums[0, 1:])
    np.cumsum(mix(values ^ U(0xABCDEF)), out=sums[1, 1:])
    end = np.cumsum(sizes)
    return (sums[:, end] - sums[:, end - sizes]).view(np.int64)


def sketches(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of sets as longs, one sketch behind the other, and their lengths: whether each bucket holds an odd number of elements.
    A sketch has at least as many bits as its set has elements, a power of two of longs; its halves fold (by xor) into one of half the length."""
    longs = np.maximum(LEAST_LONGS, 1 << np.ceil(np.log2(np.maximum(sizes, 1) / 64)).clip(0).astype(np.int64))
    of = np.repeat(np.cumsum(longs) - longs, sizes)
    bits = np.zeros(longs.sum(), U)
    np.bitwise_xor.at(bits, of + ((values >> U(6)) & np.repeat(longs - 1, sizes).astype(U)).astype(np.int64), U(1) << (values & U(63)))
    return bits, longs


def _measured(how: Shingles):
    """Number of shingles, a key of 128 bits (of the sets by both hashes, a sum each) and a sketch for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, i, j in chunks(batch, lower=True, keys=how.keys):
                values, sizes = _flat(texts, how.q)
                a, b = _keys(values, sizes)[0], _keys(*_flat(texts, how.q, second=True))[1]
                bits, longs = sketches(values, sizes)
                sketch = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(longs)].astype(np.int32)), pa.array(bits.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(sizes), pa.array(a), pa.array(b), sketch], ["doc_id", "n_shingles", "key_a", "key_b", "sketch"])

    return run


def _signed(how: Shingles, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = bands(percent, 1 << 20)
        for batch in batches:
            for texts, _, _ in chunks(batch, lower=True, keys=how.keys):
                values, sizes = _flat(texts, how.q)
                a, b = _keys(values, sizes)
                order = np.lexsort((texts.ids, ~texts.known, b, a))  # of equal sets only the smallest id signs here
                again = np.zeros(len(sizes), bool)
                again[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
                signs = texts.known & ~again & (sizes > 0)
                values, sizes, ids = values[np.repeat(signs, sizes)], sizes[signs], texts.ids[signs].astype(np.int64)
                while len(sizes) and low[-2] <= sizes.max():
                    low.append(low[-1] * 100 // percent + 1)
                sig, owner = signatures(values, sizes, percent, low)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(ids[owner])], ["sig", "doc"])

    return run


def _arrays(how: Shingles, names: list[str], part: int = 0):
    """Rows (id, text, ...) to (id, ..., key, shingles), key: of the set; with part also n, its size, and of the shingles one in part (a power of two)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, i, j in chunks(batch, lower=True, keys=how.keys):
                values, sizes = _flat(texts, how.q)
                key, kept = _keys(values, sizes)[0], (values & U(max(part, 1) - 1)) == 0
                offs = pa.array(np.r_[0, np.cumsum(kept)][np.r_[0, np.cumsum(sizes)]].astype(np.int32))
                sets = pa.ListArray.from_arrays(offs, pa.array(values[kept].view(np.int64)))
                others = [batch.column(k)[i:j] for k in range(2, batch.num_columns)]
                size = {"n": pa.array(sizes)} if part else {}
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], *others, pa.array(key), sets, *size.values()], [*names, *size])

    return run


def _picked(docs: DataFrame, ids: DataFrame, many: int, on: str = "id") -> DataFrame:
    """The rows of docs (id, text) with an id in ids (on, ...), beside what ids has: no text moves while ids has at most BROADCAST_IDS rows."""
    return docs.join(F.broadcast(ids) if many <= BROADCAST_IDS else ids, docs["id"] == ids[on]).select(docs["id"], "text", *[c for c in ids.columns if c != on])


def _odd(x: str, y: str) -> str:
    """SQL: buckets of unlike parity of two sketches, the longer one folded to the other's length; each holds at least one difference."""
    w = f"least(size({x}), size({y}))"
    one = lambda c: f"aggregate(sequence(i, size({c}) - 1, {w}), 0L, (t, k) -> t ^ get({c}, k))"
    return f"aggregate(sequence(0, {w} - 1), 0, (sum, i) -> sum + bit_count({one(x)} ^ {one(y)}))"


def _likely(sets: DataFrame, pairs: DataFrame, ids: DataFrame, many: int, few: int, percent: int) -> DataFrame:
    """A durable table of the pairs (a, b) whose sizes and sketches allow that they link: no pair that does is lost."""
    sets = sets.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    left, right = (
        sets.join(F.broadcast(t) if count <= BROADCAST_IDS else t, sets["id"] == t[on]).select(*t.columns, F.col("n").alias(f"n_{on}"), F.col("sketch").alias(f"s_{on}"))
        for t, on, count in ((pairs, "a", many), (ids, "b", few))
    )
    sizes = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    both = left.join(right, "b").where(sizes).where(f"{100 + percent} * {_odd('s_a', 's_b')} <= {100 - percent} * (n_a + n_b)")
    return durable(both.select("a", "b"), "likely")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, how: Shingles, percent: int) -> DataFrame:
    """A durable table of the pairs (a, b) whose shingle sets have 100 * intersection >= percent * union, compared exactly.

    Most pairs that meet by chance differ in more buckets of their sketches than similar sets can, so only few sets are moved.
    """
    pairs = durable(pairs, "pairs")
    ids = durable(pairs.select("b").distinct(), "ids")
    likely = _likely(sets, pairs, ids, pairs.count(), ids.count(), percent)
    release(pairs)
    release(ids)
    ids = durable(likely.select("b").distinct(), "ids")
    left = _picked(docs, likely, likely.count(), "a").mapInArrow(_arrays(how, ["a", "b", "ka", "x"]), "a long, b long, ka long, x array<long>")
    right = _picked(docs, ids, ids.count(), "b").mapInArrow(_arrays(how, ["b", "kb", "y"]), "b long, kb long, y array<long>")
    same = F.size(F.array_intersect("x", "y"))
    both = left.join(right, "b").where(100 * same >= percent * (F.size("x") + F.size("y") - same))
    found = durable(both.select("a", "b"), "links")  # not made distinct here: that would bind all rows of a centre to one task
    release(likely)
    release(ids)
    return found


def _parities() -> list[Column]:
    """Aggregates of a column s of shingles: whether each of 64 * PARITIES buckets holds an odd number of them, as bits of longs p0, p1, ..."""
    return [F.bit_xor(F.expr(f"if(shiftright(s, 6) & {PARITIES - 1} = {j}, shiftleft(1L, cast(s & 63 as int)), 0L)")).alias(f"p{j}") for j in range(PARITIES)]


def _open_rows(docs: DataFrame, members: DataFrame, how: Shingles, percent: int) -> DataFrame | None:
    """A durable table (s, doc, comp, n, w, most, p0, ...) of the rarest shingles of the documents in members (sig, doc, comp) that can still
    link with one in another component, with parity bits of their common shingles; None without any.

    w: shingles that no other open document has, less the differences that a similar pair may have; of a
    pair w is not positive in sum. most: the largest set that shares enough with the other shingles. Of the rarest
    shingles given here two similar sets share one at least.
    """
    members = durable(members, "members")
    for turn in range(PEELS + 1):
        now = durable(members.select("doc", "comp").distinct(), "open")
        many = now.count()
        if not many:
            return None
        texts = _picked(docs, now.withColumnRenamed("doc", "id"), many)
        # most documents are settled by a part of their shingles; repeated rows matter to the counts of the last turn alone
        texts, part = (texts.dropDuplicates(["id", "text"]), 1) if turn else (texts, FIRST_PEEL)
        sets = texts.mapInArrow(_arrays(how, ["doc", "comp", "key", "shingles"], part), "doc long, comp long, key long, shingles array<long>, n long")
        sets = durable(sets, "peel")
        each = sets.select("doc", F.explode("shingles").alias("s"))
        found_in = each.groupBy("s").agg(F.count("*").alias("df"), F.min("doc").alias("doc"), F.max("doc").alias("other"))
        alone = found_in.where("doc = other").groupBy("doc").agg(F.count("*").alias("alone"))
        whole = sets.groupBy("doc", "comp").agg(F.max("n").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        several = F.col("lo") < F.col("hi")  # an id with several sets stays
        own = F.coalesce("alone", F.lit(0))
        w = F.when(several, -FREE).otherwise((100 + percent) * own - (100 - percent) * F.col("n"))
        most = F.when(several, FREE).otherwise(F.floor((100 * F.col("n") - (100 + percent) * own) / percent + 1e-6))
        state = durable(whole.join(alone, "doc", "left").select("doc", "comp", F.when(several, 0).otherwise(F.col("n")).cast("long").alias("n"), w.cast("long").alias("w"), most.cast("long").alias("most")), "state")
        if turn < PEELS:
            held = members.join(state.select("doc", "n", "w", "most"), "doc")
            least = held.groupBy("sig").agg(F.min("w").alias("least"), F.min("n").alias("smallest"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
            can = f"w + least <= 0 and most >= smallest and most * 100 >= n * {percent}"
            after = durable(held.join(least, "sig").where(can).select("sig", "doc", "comp"), "members")
            for old in (members, now, sets, state):
                release(old)
            members = after
    counted = durable(each.join(found_in.select("s", "df"), "s"), "counted")
    parities = counted.where("df > 1").groupBy("doc").agg(*_parities())
    ranked = counted.withColumn("turn", F.row_number().over(W.partitionBy("doc").orderBy("df", "s")))
    rare = ranked.join(state.join(parities, "doc"), "doc").where(f"n = 0 or turn <= n - ceil(n * {percent} / 100) + 1").where("df > 1")
    rows = durable(rare.drop("df", "turn"), "rare")
    release(counted)
    for old in (members, now, sets, state):
        release(old)
    return rows


def jaccard_components(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", q: int = 5, percent: int = 80) -> DataFrame:
    """Rows (id_col, n_shingles, component_id): near-duplicate groups by word-shingle Jaccard similarity.

    Two documents link when 100 * |A & B| >= percent * |A | B|; a component is what links reach, named by its smallest id.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    how = Shingles(q, draw_keys())
    measured = durable(docs.mapInArrow(_measured(how), "doc_id long, n_shingles long, key_a long, key_b long, sketch array<long>"), "sets")
    key = ["n_shingles", "key_a", "key_b"]
    classes = durable(measured.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")), "classes")
    # an id with several sets is one node: it is tied to the smallest id of each of them
    several = measured.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi"))
    several = durable(several.where("lo <> hi").select("doc_id"), "several")
    ties = measured.join(several, "doc_id", "left_semi").join(classes, key).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # any other id behind the smallest of its set has the same signatures as that one
    copies = measured.join(classes.where("rep < last"), key).where("doc_id > rep").select(F.col("doc_id").alias("doc")).distinct()
    copies = durable(copies.join(several.withColumnRenamed("doc_id", "doc"), "doc", "left_anti"), "copies")
    few = copies.count() <= BROADCAST_IDS

    sources = docs.join(F.broadcast(copies), docs["id"] == copies["doc"], "left_anti") if few else docs
    by_sig = W.partitionBy("sig").orderBy("doc").rowsBetween(W.unboundedPreceding, W.currentRow)
    signed = sources.mapInArrow(_signed(how, percent), "sig long, doc long")
    shared = signed.withColumn("centre", F.min("doc").over(by_sig)).where("doc > centre")
    shared = durable(shared if few else shared.join(copies, "doc", "left_anti"), "sigs")
    met = durable(shared.groupBy("doc", "centre").agg(F.count("*").alias("votes")), "met")

    best = met.groupBy("doc").agg(F.max_by("centre", F.struct("votes", -F.col("centre"))).alias("centre"))
    links = _verified(docs, measured, best.select(F.col("doc").alias("a"), F.col("centre").alias("b")), how, percent).unionByName(ties)
    comps = durable(connected_components(links, "a", "b"), "comps")
    rest = _apart(met.join(best, ["doc", "centre"], "left_anti").select(F.col("doc").alias("a"), F.col("centre").alias("b")), comps)
    links, comps = _more(docs, measured, rest, links, comps, how, percent)

    # what a signature's smallest id left in several components
    apart = durable(_apart(met.select(F.col("doc").alias("a"), F.col("centre").alias("b")), comps), "apart")
    bad = shared.join(apart.select(F.col("a").alias("doc"), F.col("b").alias("centre")), ["doc", "centre"], "left_semi").select("sig").distinct()
    held = shared.join(durable(bad, "bad"), "sig", "left_semi")
    held = held.select("sig", "doc").unionAll(held.select("sig", F.col("centre").alias("doc")).distinct())
    crowded = held.groupBy("sig").agg(F.count("*").alias("size")).where("size > 2")  # of two, the one pair was compared
    rows = _open_rows(docs, _with_component(held.join(crowded, "sig", "left_semi").select("sig", "doc"), comps), how, percent)
    if rows is not None:
        left, right = (rows.select("s", *[F.col(c).alias(f"{c}_{x}") for c in rows.columns if c != "s"]) for x in "ab")
        # buckets of unlike parity hold at least one difference each
        odd = " + ".join(f"bit_count(p{j}_a ^ p{j}_b)" for j in range(PARITIES))
        near = f"comp_a < comp_b and w_a + w_b + {100 + percent} * ({odd}) <= 0 and n_b <= most_a and n_a <= most_b and (n_a = 0 or n_b = 0 or 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b))"
        pairs = left.join(right, "s").where(near).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).distinct()
        links, comps = _more(docs, measured, pairs, links, comps, how, percent)
    for old in (shared, met, apart, rows, copies):
        release(old)

    named = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = measured.join(named, key, "left")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _more(docs: DataFrame, sets: DataFrame, pairs: DataFrame, links: DataFrame, comps: DataFrame, how: Shingles, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and components with those of further pairs (a, b)."""
    found = _verified(docs, sets, pairs, how, percent)
    if found.isEmpty():
        return links, comps
    links = links.unionByName(found)
    again = durable(connected_components(links, "a", "b"), "comps")
    release(comps)
    return links, again


def _with_component(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps.withColumnRenamed("node", "doc"), "doc", "left").select(*members.columns, F.coalesce("component", "doc").alias("comp"))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in different components."""
    for x in "ab":
        pairs = pairs.join(comps.select(F.col("node").alias(x), F.col("component").alias(f"comp_{x}")), x, "left").withColumn(f"comp_{x}", F.coalesce(f"comp_{x}", x))
    return pairs.where("comp_a <> comp_b").select("a", "b")


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", q: int = 5, percent: int = 80) -> DataFrame:
    """The input's rows (all columns) of one document of each near-duplicate group: its smallest id."""
    comps = jaccard_components(documents, id_col=id_col, text_col=text_col, q=q, percent=percent)
    gone = durable(comps.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct(), "gone")
    same = documents[id_col].cast("long") == gone["__gone"]
    return documents.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, same, "left_anti")
