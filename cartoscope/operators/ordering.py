"""Ordering, top-k, samples, set operations and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable


def presence(keys: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """keys with a boolean: whether found has a row of that key."""
    have = found.select(F.col(key).alias("__k")).distinct()
    return keys.join(have, F.col(key) == F.col("__k"), "left").select(*keys.columns, F.col("__k").isNotNull().alias(name))


def first_rows(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def sorted_by(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.orderBy(*order)


#: Rows that a task sorts and numbers.
RANGE_ROWS = 500_000


def distinct_positions(rows: DataFrame, within: str, order: Sequence[str], name: str) -> DataFrame:
    """Distinct rows (within, order) with 0-based dense positions within groups.

    The rows are dealt by ranges of (within, order), about RANGE_ROWS each, so a group may lie in many tasks; only one count a range and group is
    added up in one place.
    """
    keys = [within, *order]
    parts = max(1, -(-rows.count() // RANGE_ROWS))
    # written once: both the counts and the rows see the same ranges
    here = rows.select(*keys).repartitionByRange(parts, *keys).distinct().withColumn("__p", F.spark_partition_id())
    here = durable(here.withColumn("__at", F.row_number().over(W.partitionBy("__p", within).orderBy(*order))), "positions")
    sizes = here.groupBy(F.col("__p").alias("__q"), F.col(within).alias("__w")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy("__w").orderBy("__q").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__q", "__w", before.alias("__before"))
    out = here.join(F.broadcast(sizes), (F.col("__p") == F.col("__q")) & F.col(within).eqNullSafe(F.col("__w")))
    return out.select(*keys, (F.col("__before") + F.col("__at") - 1).cast("long").alias(name))


def positions(rows: DataFrame, within: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """0-based dense positions within groups."""
    return rows.withColumn(name, (F.row_number().over(W.partitionBy(*within).orderBy(*order)) - 1).cast("long"))


def top_frequent(rows: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The n most frequent values; ties go to the smaller value."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns).limit(n)


def sample_rows(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows, the first by a hash of the key: repeatable, whatever the partitions."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def split_fraction(rows: DataFrame, key: str, percent: int, seed: int) -> DataFrame:
    """rows with a boolean column train, true for percent of the keys."""
    return rows.withColumn("train", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100)) < percent)


def sample_per_class(rows: DataFrame, column: str, wanted: Mapping[int, int], key: str, seed: int) -> DataFrame:
    """As many rows of each class as wanted, by a hash of the key."""
    rank = F.row_number().over(W.partitionBy(column).orderBy(F.xxhash64(key, F.lit(seed)), key))
    limit = F.lit(0)
    for k, n in wanted.items():
        limit = F.when(F.col(column) == k, n).otherwise(limit)
    return rows.where(F.col(column).isin(list(wanted))).withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__rank")


def bootstrap_means(rows: DataFrame, key: str, value: str, replicates: int, seed: int) -> DataFrame:
    """Mean of a value in each of some bootstrap replicates.

    Each row is drawn a Poisson(1) number of times in a replicate, decided by a hash of its key, so
    a replicate needs no index join and one pass makes all of them.
    """
    cuts = []
    p = total = 2.718281828459045**-1
    for k in range(1, 12):
        cuts.append(total)
        p /= k
        total += p
    u = F.pmod(F.xxhash64(key, "replicate", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    times = sum(((u >= c).cast("int") for c in cuts[1:]), (u >= cuts[0]).cast("int"))
    drawn = rows.select(key, value, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")).withColumn("times", times)
    return drawn.groupBy("replicate").agg(F.sum("times").cast("long").alias("n"), (F.sum(F.col("times") * F.col(value)) / F.sum("times")).alias("mean"))


def union_sources(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All parts with a column source that names each."""
    out = None
    for name, part in parts.items():
        part = part.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def compare_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both sides with a status: both, left_only, right_only."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    status = F.when(F.col("a").isNull(), "right_only").when(F.col("b").isNull(), "left_only").otherwise("both")
    return a.join(b, F.col("a") == F.col("b"), "full").select(F.coalesce("a", "b").alias(key), status.alias("status"))


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with the table's columns; keys the table lacks are dropped."""
    return rows.join(table, key)
