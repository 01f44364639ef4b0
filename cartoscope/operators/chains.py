"""Products of affine section-to-previous transforms along the sections of an animal.

A transform is a 2 x 3 matrix (ENTRIES) of the plane. Products do not commute, so running products are made by
a parallel scan: the rows are dealt by ranges of (key, order), each range makes the running products of its own rows,
the products of whole ranges are folded in order (one short list a key, no longer than there are ranges), and each
row's product is joined to what stands before its range. A key with a third of all sections lies in many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release

#: Entries of a 2 x 3 matrix, line by line; the third line is 0 0 1.
ENTRIES = ("m00", "m01", "m02", "m10", "m11", "m12")
KIND = f"struct<{','.join(f'{c}:double' for c in ENTRIES)}>"


def product(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    """Entries of a b: b is applied first."""
    return [a[i] * b[k] + a[i + 1] * b[3 + k] + (a[i + 2] if k == 2 else F.lit(0.0)) for i in (0, 3) for k in range(3)]


def inverse(m: Sequence[Column]) -> list[Column]:
    """Entries of the inverse; null if there is none."""
    a, b, c, d, e, f = m
    det = F.nullif(a * e - b * d, F.lit(0.0))
    return [e / det, -b / det, (b * f - e * c) / det, -d / det, a / det, (d * c - a * f) / det]


def as_struct(m: Sequence[Column]) -> Column:
    return F.struct(*[v.cast("double").alias(c) for v, c in zip(m, ENTRIES, strict=True)])


def entries(m: Column) -> list[Column]:
    return [m[c] for c in ENTRIES]


def identity() -> Column:
    return as_struct([F.lit(float(v)) for v in (1, 0, 0, 0, 1, 0)])


def folded(matrices: Column) -> Column:
    """Product of an array of matrices (structs of ENTRIES), the last one leftmost; the identity for an empty array."""
    return F.aggregate(matrices, identity(), lambda seen, m: as_struct(product(entries(m), entries(seen))))


def scanned(matrices: Column) -> Column:
    """For each element of an array of matrices the product of all up to it."""
    start = F.struct(F.array().cast(f"array<{KIND}>").alias("out"), identity().alias("seen"))

    def step(acc: Column, m: Column) -> Column:
        now = as_struct(product(entries(m), entries(acc["seen"])))
        return F.struct(F.array_append(acc["out"], now).alias("out"), now.alias("seen"))

    return F.aggregate(matrices, start, step, lambda acc: acc["out"])


def running(m: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Running products of 3 x 3 matrices within runs that begin where new is true, by doubling: log2 of the longest run steps."""
    m = m.copy()
    start = np.maximum.accumulate(np.where(new, np.arange(len(m)), 0))
    reach = np.arange(len(m)) - start
    step = 1
    while step <= reach.max(initial=0):
        some = np.flatnonzero(reach >= step)
        m[some] = m[some] @ m[some - step]
        step *= 2
    return m


#: Entries of the product of the rows before one.
BEHIND = tuple(f"b{c}" for c in ENTRIES)


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, at, ENTRIES) of one range to (part, key, at, place, ENTRIES, BEHIND): places and running products of each key within the range, with and without the row itself."""
    part = TaskContext.get().partitionId()
    last, place, before = None, 0, np.eye(3)
    for batch in batches:
        if not len(batch):
            continue
        codes = batch.column(0).dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False)
        m = np.zeros((len(code), 3, 3))
        m[:, 2, 2] = 1
        for k in range(6):
            m[:, k // 3, k % 3] = batch.column(2 + k).to_numpy(zero_copy_only=False)
        new = np.r_[True, code[1:] != code[:-1]]
        m = running(m, new)
        head = np.flatnonzero(new)
        places = np.arange(len(code)) - np.repeat(head, np.diff(np.r_[head, len(code)]))
        goes_on = last == batch.column(0)[0].as_py()  # the key of the batch before
        if goes_on:
            run = int(head[1]) if len(head) > 1 else len(code)
            m[:run] = m[:run] @ before
            places[:run] += place
        behind = np.concatenate([before[None], m[:-1]])
        behind[head[1:] if goes_on else head] = np.eye(3)
        last, place, before = batch.column(0)[len(code) - 1].as_py(), int(places[-1]) + 1, m[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), part, np.int32)), batch.column(0), batch.column(1), pa.array(places), *[pa.array(np.ascontiguousarray(v[:, k // 3, k % 3])) for v in (m, behind) for k in range(6)]], ["part", "key", "at", "place", *ENTRIES, *BEHIND])


def running_products(transforms: DataFrame, key: str, order: str, parts: int | None = None, descending: bool = False, without_own: bool = False) -> DataFrame:
    """A durable table (key, order, place, n, ENTRIES): for each row of a key the product of its matrices from the first one up to it.

    place: 0-based; n: rows of the key. Rows with a null key or order are left out; a null entry makes the products from
    there on NaN. parts: ranges to deal the rows to. descending: from the last row back. without_own: up to the row before.
    """
    rows = transforms.select(F.col(key).alias("key"), F.col(order).alias("at"), *[F.col(c).cast("double").alias(c) for c in ENTRIES]).where("key is not null and at is not null")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("key", "at")}
    many = [parts] if parts else []
    at = F.desc("at") if descending else F.asc("at")
    dealt = rows.repartitionByRange(*many, "key", at).sortWithinPartitions("key", at, *ENTRIES)
    here = durable(dealt.mapInArrow(_ranged, f"part int, key {kinds['key']}, at {kinds['at']}, place long, {', '.join(f'{c} double' for c in (*ENTRIES, *BEHIND))}"), "ranges")
    whole = here.groupBy("key", "part").agg(F.max_by(F.struct(*ENTRIES), "place").alias("m"), F.count("*").alias("rows"))
    lists = whole.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("part", "m", "rows"))).alias("x"), F.sum("rows").alias("n"))
    # what stands before each range: the product and the rows of the ranges before it
    counted = F.aggregate("x.rows", F.array(F.lit(0).cast("long")), lambda a, v: F.array_append(a, F.element_at(a, -1) + v))
    each = lists.select("key", "n", F.col("x.part").alias("part"), counted.alias("ahead"), F.concat(F.array(identity()), scanned(F.col("x.m"))).alias("b"))
    before = each.select("key", "n", F.explode(F.slice(F.arrays_zip("part", "ahead", "b"), 1, F.size("part"))).alias("r")).select("key", "n", "r.*")
    rows = here.join(before, ["key", "part"])
    now = product([F.col(c) for c in (BEHIND if without_own else ENTRIES)], entries(F.col("b")))
    out = rows.select(F.col("key").alias(key), F.col("at").alias(order), (F.col("place") + F.col("ahead")).alias("place"), "n", *[v.alias(c) for v, c in zip(now, ENTRIES, strict=True)])
    out = durable(out, "products")
    release(here)
    return out


def to_middle(transforms: DataFrame, key: str, order: str, parts: int | None = None) -> DataFrame:
    """Rows (key, order, ENTRIES): the transform of every section of a key to its middle one (place n // 2).

    Above the middle these are products of section-to-previous transforms outward, below it products of inverses. Both
    start at the middle: by way of the first section, long chains would cancel what is left of a double.
    """
    upto = running_products(transforms, key, order, parts)
    middle = durable(upto.where("place = n div 2").select(F.col(key).alias("__key"), F.col(order).alias("__at")), "middle")
    release(upto)
    rows = transforms.join(middle, F.col(key) == F.col("__key"))
    entry = [F.col(c).cast("double") for c in ENTRIES]
    above = running_products(rows.where(F.col(order) > F.col("__at")), key, order, parts)
    back = rows.where(F.col(order) <= F.col("__at")).select(key, order, *[v.alias(c) for v, c in zip(inverse(entry), ENTRIES, strict=True)])
    below = running_products(back, key, order, parts, descending=True, without_own=True)
    out = above.select(key, order, *ENTRIES).unionByName(below.select(key, order, *ENTRIES))
    # a matrix without an inverse up to the middle leaves a key no results
    lost = back.where(F.col(ENTRIES[0]).isNull() & F.col(order).isNotNull()).select(F.col(key).alias("__lost")).distinct()
    out = out.join(lost, F.col(key) == F.col("__lost"), "left")
    return out.select(key, order, *[F.when(F.col("__lost").isNull(), F.col(c)).alias(c) for c in ENTRIES])
