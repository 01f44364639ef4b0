"""URL filters by a Bloom filter cascade, in DataFrame functions only.

A rule list is a set of keys `host suffix + path prefix`. The key universe is every key that some URL of the
corpus could match: each suffix of each host with each path prefix of a rule's length. Level 0 is
a Bloom filter of the listed keys; level 1 holds the universe's keys that pass level 0 without being listed;
level 2 the listed keys that pass level 1, and so on until no false positive is left. A key of the universe is
listed if the first level that it fails is odd, so membership is exact, and URLs are judged in one
projection without a join to any list.

Keys are dealt to hash slices so that the bits of one slice stay under SLICE_BITS. The number of slices
follows from a count: with one slice the bits (under 32 MB a level) are one broadcast row; with more, each key takes its
slice's row by an equi-join on the slice number, after the distinct keys have been found.

Defined results: a null URL, or one without ://, has the empty host and path, fits no rule, and gets
the method's verdict. Empty tables give empty results; without any listed key nothing is listed.
Extra columns of the pages are ignored; repeated rows and rows with a null id are judged each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable

#: Hash places and bits of a key in a level; bits of a level in one slice, at most; levels, at most.
PLACES, KEY_BITS, SLICE_BITS, LEVELS = 4, 12, 1 << 28, 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: between the first :// and the next /, ? or #, A-Z lower-cased. Path: from there to ? or #. Both empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise(F.lit(""))
    host, path = F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key that a host and path could match: the host and what stands behind each dot, with path prefixes of these lengths."""
    parts = F.split(host, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fit = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    starts = F.transform(fit, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(ends, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def _place(key: Column, level: int, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level * PLACES + k)), F.lit(bits))


def _passes(words: Column, key: Column, level: int, bits: int) -> Column:
    """Whether all of the key's places are set in a level's words of 64 bits."""
    out = None
    for k in range(PLACES):
        place = _place(key, level, k, bits)
        word = F.element_at(words, (F.floor(place / 64) + 1).cast("int"))
        is_set = F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1
        out = is_set if out is None else out & is_set
    return out


@dataclass
class Cascade:
    """levels: rows (slice, one array column a level, named by prefix and number); bits: of each level in a slice."""

    levels: DataFrame | None
    bits: list[int]
    slices: int
    prefix: str = ""

    def slice_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(self.slices))

    def beside(self, rows: DataFrame, key: Column | None = None) -> DataFrame:
        """rows with the level columns of the key's slice; with one slice those of the broadcast row."""
        if self.levels is None:
            return rows
        if self.slices == 1:
            return rows.crossJoin(F.broadcast(self.levels.drop("slice")))
        return rows.withColumn("slice", self.slice_of(key)).join(self.levels, "slice").drop("slice")

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed, in rows that beside() gave the level columns."""
        out = F.lit(len(self.bits) % 2 == 1)  # passes every level: the last one decides
        for level in reversed(range(len(self.bits))):
            here = _passes(F.col(f"{self.prefix}{level}"), key, level, self.bits[level])
            out = F.when(here, out).otherwise(F.lit(level % 2 == 1))
        return out


def build(listed: DataFrame, universe: DataFrame, prefix: str = "level") -> Cascade:
    """The cascade of the listed keys over a universe; both have one string column key."""
    spark = universe.sparkSession
    listed = listed.where("key is not null").distinct()
    inside = durable(universe.join(listed, "key", "left_semi").distinct(), "listed")
    outside = durable(universe.join(listed, "key", "left_anti").where("key is not null").distinct(), "others")
    n = inside.count()
    out = Cascade(None, [], max(1, -(-n * KEY_BITS * 2 // SLICE_BITS)), prefix)
    current, other = inside, outside
    while n:
        level, bits = len(out.bits), max(64, -(-n * KEY_BITS // out.slices))
        if level == LEVELS:
            raise ValueError("the cascade does not end")
        places = current.select(out.slice_of(F.col("key")).alias("slice"), F.explode(F.array(*[_place(F.col("key"), level, k, bits) for k in range(PLACES)])).alias("p"))
        words = places.select("slice", F.floor(F.col("p") / 64).alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
        wide = (bits + 63) // 64
        none = spark.range(wide * out.slices).select(F.floor(F.col("id") / wide).alias("slice"), (F.col("id") % wide).alias("w"), F.lit(0).cast("long").alias("b"))
        words = words.unionByName(none).groupBy("slice", "w").agg(F.bit_or("b").alias("b"))  # OR-ed map-side before they meet
        name = f"{prefix}{level}"
        made = words.groupBy("slice").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias(name))
        made = durable(made, "level")
        alone = Cascade(made, [*out.bits, bits], out.slices, prefix)
        wrong = alone.beside(other, F.col("key")).where(_passes(F.col(name), F.col("key"), level, bits)).select("key")
        out.levels = made if out.levels is None else out.levels.join(made, "slice")
        out.bits.append(bits)
        current, other = durable(wrong, "wrong"), current
        n = current.count()
    if out.levels is not None and len(out.bits) > 1:
        out.levels = durable(out.levels, "cascade")
    return out


def _longest(keys: Column) -> Column:
    """The longest of some keys; null for none. Of equal length the last in string order."""
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))


def judge(pages: DataFrame, allow: DataFrame, block: DataFrame, blocked_hosts: DataFrame, lengths: list[int], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (id_col, host, path, rule, verdict): the longest fitting rule decides, else block for listed hosts and allow for others.

    allow, block: rules as keys like `net/es/`; blocked_hosts: whole hosts; all with one column key.
    lengths: the distinct lengths of the rules' paths.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    seen = rows.select("host", "path").distinct()
    universe = durable(seen.select(F.explode(candidates(F.col("host"), F.col("path"), lengths)).alias("key")).distinct(), "universe")
    rules = {"allow": build(allow, universe, "allow"), "block": build(block, universe, "block")}
    hosts = build(blocked_hosts, rows.select(F.col("host").alias("key")).distinct(), "host")
    keys = candidates(F.col("host"), F.col("path"), lengths)
    if max(c.slices for c in (*rules.values(), hosts)) == 1:
        out = rows
        for c in (*rules.values(), hosts):
            out = c.beside(out)
        for name, c in rules.items():
            out = out.withColumn(name, _longest(F.filter(keys, c.contains)))
        out = out.withColumn("listed", hosts.contains(F.col("host"))).select("id", "host", "path", "allow", "block", "listed")
    else:  # distinct hosts and paths take each key's slice, and come back to the rows by one join
        each = seen.select("host", "path", F.explode_outer(keys).alias("key"))
        for name, c in rules.items():
            each = c.beside(each, F.coalesce("key", F.lit(""))).withColumn(name, F.when(c.contains(F.col("key")), F.struct(F.length("key").alias("n"), "key"))).select("host", "path", "key", *[x for x in rules if x == name or x in each.columns])
        each = each.groupBy("host", "path").agg(*[F.max(x).alias(x) for x in rules])
        each = hosts.beside(each, F.col("host")).withColumn("listed", hosts.contains(F.col("host"))).select("host", "path", "allow", "block", "listed")
        out = rows.join(each, ["host", "path"])
    blocked = F.col("block").isNotNull() & (F.col("allow").isNull() | (F.col("block.n") > F.col("allow.n")))
    rule = F.when(blocked, F.col("block.key")).otherwise(F.col("allow.key"))
    verdict = F.when(blocked, "block").when(F.col("allow").isNotNull() | ~F.col("listed"), "allow").otherwise("block")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"))
