"""Exact percentiles of many groups at once, by counted refinement of value ranges: no task holds a group.

A group that is small is sorted as it is. Of a larger one, splitters (approximate quantiles, a summary of bounded size)
cut the values into ranges; counting the ranges tells in which one each wanted rank lies, and only the rows of these
ranges stay for the next round. A value that is a splitter is a range of its own, so a value of any frequency is found
by its count. The splitters decide how fast the ranges shrink, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release, together

#: Rows of a range that are sorted in one place.
BOUND = 50_000
#: Ranges into which splitters cut the one before.
SPLITS = 32
#: Relative precision of the splitters' ranks.
ACCURACY = 1_000


def percentiles(rows: DataFrame, keys: Sequence[str], value: str | Column, at: Sequence[float], name: str = "p", bound: int = BOUND) -> DataFrame:
    """Rows (keys, name): of each group the array of exact percentiles at shares, with linear interpolation between ranks.

    Null values don't count; a group without others has a null array. Null keys are a group of their own, NaN is above
    all numbers. Whole numbers are compared as doubles. Without keys the result is one row; without rows and keys too.
    """
    g = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(0).alias("none")).alias("g")
    v = (F.col(value) if isinstance(value, str) else value).cast("double").alias("v")
    values = durable(rows.select(g, v, F.lit(0).cast("long").alias("part")), "values")
    groups = durable(values.groupBy("g").agg(F.count("v").alias("n")), "groups")
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*[f(_place(p)).cast("long") for f in (F.floor, F.ceil)]) for p in at])))
    wanted = groups.where("n > 0").select("g", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("before"), F.col("n").alias("size"))
    wanted, found = durable(wanted, "ranks"), []
    while not wanted.isEmpty():
        found.append(durable(_sorted(values, wanted.where(F.col("size") <= bound)), "found"))
        large = wanted.where(F.col("size") > bound)
        if large.isEmpty():
            break
        values, after, settled = _narrowed(values, large)
        found.append(settled)
        release(wanted)
        wanted = after
    release(values)
    release(wanted)
    if not found:
        out = groups.select("g", F.lit(None).cast("array<double>").alias(name))
    else:
        hits = together(found).groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("of"))  # two entries a share at most
        out = groups.join(hits, "g", "left").select("g", F.when(F.col("n") > 0, F.array(*[_between(p) for p in at])).alias(name))
    if not keys:
        one = rows.sparkSession.range(1).select(F.struct(F.lit(0).alias("none")).alias("g"))
        out = one.join(out, "g", "left")
    return out.select(*[F.col(f"g.k{i}").alias(k) for i, k in enumerate(keys)], name)


def _place(share: float) -> Column:
    return F.lit(float(share)) * (F.col("n") - 1)


def _between(share: float) -> Column:
    """The value at a share, from the two ranks around it."""
    at = _place(share)
    low, high = (F.col("of")[f(at).cast("long")] for f in (F.floor, F.ceil))
    return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)


def _sorted(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (g, rank, v) of ranks in ranges of bounded size."""
    few = values.where("v is not null").join(wanted.select("g", "part").distinct(), ["g", "part"], "left_semi")
    lists = few.groupBy("g", "part").agg(F.sort_array(F.collect_list("v")).alias("all"))
    return wanted.join(lists, ["g", "part"]).select("g", "rank", F.col("all")[(F.col("rank") - F.col("before")).cast("int")].alias("v"))


def _narrowed(values: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: the rows of the ranges that hold wanted ranks, these ranks in them, and the ranks whose value is certain."""
    held = values.where("v is not null").join(wanted.select("g", "part").distinct(), ["g", "part"], "left_semi")
    shares = F.array(*[F.lit(k / SPLITS) for k in range(SPLITS + 1)])
    cuts = durable(held.groupBy("g", "part").agg(F.array_distinct(F.percentile_approx("v", shares, ACCURACY)).alias("cuts")), "cuts")
    lower = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    bins = 2 * lower + F.array_contains("cuts", F.col("v")).cast("int")  # odd: equal to a splitter
    each = held.join(cuts, ["g", "part"]).select("g", "v", (F.col("part") * (2 * SPLITS + 3) + bins).alias("part"), F.col("part").alias("up"))
    counts = each.groupBy("g", "up", "part").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = F.sum("n").over(W.partitionBy("g", "up").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))  # 67 ranges at most
    counts = counts.withColumn("first", upto - F.col("n"))
    hit = wanted.withColumnRenamed("part", "up").join(counts, ["g", "up"])
    hit = hit.where((F.col("rank") - F.col("before") >= F.col("first")) & (F.col("rank") - F.col("before") < F.col("first") + F.col("n")))
    hit = durable(hit.select("g", "rank", "part", (F.col("before") + F.col("first")).alias("before"), F.col("n").alias("size"), "low", "high"), "hit")
    settled = durable(hit.where("low = high").select("g", "rank", F.col("low").alias("v")), "found")
    after = durable(hit.where("low <> high").select("g", "rank", "part", "before", "size"), "ranks")
    left = durable(each.join(after.select("g", "part").distinct(), ["g", "part"], "left_semi").select("g", "v", "part"), "values")
    for old in (values, cuts, hit):
        release(old)
    return left, after, settled
