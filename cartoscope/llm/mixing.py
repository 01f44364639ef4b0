"""Mixing sources to target weights by temperature, in DataFrame functions only.

Source shares of tokens are raised to an exponent between 0 (all sources alike) and 1 (as they are) and
normalised. The exponent is bisected, 32 trial values a round, for the largest one whose entropy reaches the target;
if some source would then be repeated more often than the limit, for the smallest one that keeps the limit.
The weights become token budgets. A budget is realised as permutations of the source's hash blocks: every
whole epoch takes all blocks in an order of its own, and the last one takes blocks until the budget is
met, the block at the end document by document. Sources have BLOCKS blocks each, so a hot source is dealt over many
keys and only block sums are ordered; the one window over documents sees one block of a source.

Defined results: null texts and texts without words count 0 tokens and come once an epoch; a null source is a
source of its own; rows with a null id are dealt to blocks by their text; repeated rows count each, and mixed_documents() gives an
id's picks to its rows in turn. A source of no
tokens gets weight 0 and one whole epoch. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable

BLOCKS, TRIALS, ROUNDS = 1024, 32, 6
#: Rows of the block plan that are broadcast at most (some 50 bytes each).
BROADCAST_PLAN = 200_000
WORD = "[^\\x20\\x09-\\x0D]+"


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("null"))


def _trials(sources: DataFrame, low: float, high: float, budget: float) -> list:
    """Entropy of the weights and the largest number of repeats at TRIALS + 1 exponents from low to high."""
    grid = [low + (high - low) * i / TRIALS for i in range(TRIALS + 1)]
    each = sources.select(F.posexplode(F.array(*map(F.lit, grid))).alias("i", "a"), F.ln("share").alias("s"), "tokens")
    each = each.withColumn("e", F.exp(F.col("a") * F.col("s")))
    sums = each.groupBy("i", "a").agg(F.sum("e").alias("z"), F.sum(F.col("e") * F.col("s")).alias("t"), F.max(F.col("e") / F.col("tokens")).alias("r"))
    rows = sums.select("a", (F.ln("z") - F.col("a") * F.col("t") / F.col("z")).alias("entropy"), (F.lit(budget) * F.col("r") / F.col("z")).alias("repeats"))
    return rows.orderBy("a").collect()  # TRIALS + 1 rows whatever the number of sources


def exponent(sources: DataFrame, budget: float, target_entropy: float, max_repeats: float) -> float:
    """sources: rows (tokens > 0, share). target_entropy: as a share of the logarithm of their number."""
    n = sources.count()
    if n < 2:
        return 1.0
    target = target_entropy * math.log(n)

    def bisect(low: float, high: float, left_of_it) -> float:
        for _ in range(ROUNDS):
            rows = _trials(sources, low, high, budget)
            k = max((i for i, r in enumerate(rows) if left_of_it(r)), default=0)
            if k == len(rows) - 1:
                return high
            low, high = rows[k]["a"], rows[k + 1]["a"]
        return low

    found = bisect(0.0, 1.0, lambda r: r["entropy"] >= target)
    if _trials(sources, found, 1.0, budget)[0]["repeats"] > max_repeats:
        found = bisect(found, 1.0, lambda r: r["repeats"] > max_repeats)
    return found


def _block(seed: int) -> Column:
    """The hash block of a row (id, text)."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.col("text")), F.lit(seed)), F.lit(BLOCKS))


def mix(documents: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", target_entropy: float = 0.95, max_repeats: float = 4.0, budget: float | None = None, seed: int = 1) -> DataFrame:
    """Rows (id_col, source, n_tokens, weight, epoch, block, block_key, doc_key): each pick of each document.

    Order by (epoch, source, block_key, doc_key) for the block permutations. budget: tokens in all, by default
    those of the input.
    """
    return _mixed(documents, id_col, source_col, text_col, target_entropy, max_repeats, budget, seed)[0]


def _mixed(documents: DataFrame, id_col: str, source_col: str, text_col: str, target_entropy: float, max_repeats: float, budget: float | None, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of mix(); its plan: how often every row of (key, block) comes as part of whole blocks; and the ids that come once more, from a block at an end."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", "source", source_key(F.col("source")).alias("key"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n"), _block(seed).alias("block"))
    rows = durable(rows, "tokens")
    blocks = durable(rows.groupBy("key", "block").agg(F.sum("n").alias("tokens")), "blocks")
    sources = blocks.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = float(total if budget is None else budget)
    shares = durable(sources.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(1, total)))), "sources")
    a = exponent(shares, budget, target_entropy, max_repeats)
    raised = F.exp(F.lit(a) * F.ln("share"))
    z = shares.agg(F.sum(raised)).first()[0] or 1.0
    plan = sources.select("key", F.col("tokens").alias("size")).join(shares.select("key", (raised / F.lit(z)).alias("weight")), "key", "left").fillna(0.0, ["weight"])
    plan = plan.withColumn("wanted", F.floor(F.col("weight") * budget))
    plan = plan.withColumn("whole", F.when(F.col("size") > 0, F.floor(F.col("wanted") / F.col("size"))).otherwise(1))
    plan = plan.withColumn("left", F.when(F.col("size") > 0, F.col("wanted") - F.col("whole") * F.col("size")).otherwise(0))

    def block_key(epoch: Column) -> Column:
        return F.xxhash64("key", "block", epoch, F.lit(seed))

    order = W.partitionBy("key").orderBy("last_key", "block").rowsBetween(W.unboundedPreceding, W.currentRow)
    dealt = blocks.join(plan, "key").withColumn("last_key", block_key(F.col("whole"))).withColumn("upto", F.sum("tokens").over(order))
    dealt = dealt.select("key", "block", "weight", "whole", (F.col("left") - F.col("upto") + F.col("tokens")).alias("room"), "tokens")
    dealt = durable(dealt, "plan")
    small = dealt.count() <= BROADCAST_PLAN
    picked = rows.join(F.broadcast(dealt) if small else dealt, ["key", "block"])
    whole = picked.where("whole > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch"))
    last = picked.where("room >= tokens and room > 0").withColumn("epoch", F.col("whole"))
    inside = W.partitionBy("key", "block").orderBy("doc_key", "id").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = picked.where("room > 0 and room < tokens").withColumn("epoch", F.col("whole")).withColumn("doc_key", F.xxhash64("id", "epoch", F.lit(seed)))
    edge = edge.withColumn("upto", F.sum("n").over(inside)).where("upto <= room").drop("upto", "doc_key")
    out = whole.unionByName(last).unionByName(edge).withColumn("doc_key", F.xxhash64("id", "epoch", F.lit(seed)))
    out = out.select(F.col("id").alias(id_col), "source", F.col("n").alias("n_tokens"), "weight", "epoch", F.col("block").cast("long").alias("block"), block_key(F.col("epoch")).alias("block_key"), "doc_key")
    return out, dealt.select("key", "block", (F.col("whole") + F.expr("room >= tokens and room > 0").cast("long")).alias("blocks")), edge.select("id")


def mixed_documents(documents: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", target_entropy: float = 0.95, max_repeats: float = 4.0, seed: int = 1) -> DataFrame:
    """The input's rows (all columns), each as often as the mix picks its id."""
    picks, plan, edge = _mixed(documents, id_col, source_col, text_col, target_entropy, max_repeats, None, seed)
    sizes = documents.groupBy(F.col(id_col).alias("of")).agg(F.count("*").alias("all"))
    # ids of one row outside the blocks at the ends are picked by the plan, so their rows meet no table of ids
    odd = durable(sizes.where("all > 1").select("of").unionByName(edge.select(F.col("id").alias("of"))).distinct(), "odd")
    times = picks.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("picks")).join(odd.withColumnRenamed("of", "odd"), F.col("id").eqNullSafe(F.col("odd")), "left_semi")
    times = durable(times.join(sizes, times["id"].eqNullSafe(sizes["of"])).select("id", "picks", "all"), "times")
    rows = documents.select(F.col(id_col).alias("row_id"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    few = odd.count() <= BROADCAST_PLAN

    def met(some: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(some) if few else some, rows["row_id"].eqNullSafe(some["id"])).select("row", "id", "picks", "all")

    plain = documents.select(F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("key"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    plain = plain.join(F.broadcast(odd) if few else odd, plain["id"].eqNullSafe(odd["of"]), "left_anti").withColumn("block", _block(seed))
    plain = plain.join(F.broadcast(plan) if plan.count() <= BROADCAST_PLAN else plan, ["key", "block"]).select("row", F.col("blocks").alias("n"))
    out = plain.unionByName(met(times.where("all = 1")).select("row", F.col("picks").alias("n")))
    several = times.where("all > 1")
    if not several.isEmpty():
        # the picks of an id are dealt to its rows in turn, none is made up; rows without an id are one group, dealt out by salts
        salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("row"), F.lit(BLOCKS))).otherwise(0)
        shared = met(several).withColumn("salt", salt)
        places = shared.groupBy("id", "salt").agg(F.count("*").alias("here"))
        before = F.sum("here").over(W.partitionBy("id").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
        places = places.select(F.col("id").alias("of"), F.col("salt").alias("at"), F.coalesce(before, F.lit(0)).alias("before"))
        shared = shared.withColumn("turn", F.row_number().over(W.partitionBy("id", "salt").orderBy(F.xxhash64("row"))))
        shared = shared.join(places, shared["id"].eqNullSafe(places["of"]) & (shared["salt"] == places["at"]))
        more = (F.col("before") + F.col("turn") <= F.col("picks") % F.col("all")).cast("long")
        out = out.unionByName(shared.select("row", (F.floor(F.col("picks") / F.col("all")) + more).alias("n")))
    return out.where("n > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")
