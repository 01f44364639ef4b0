"""Groups of nearby points, agreement, duplicates, matching, trees."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release, together
from cartoscope.operators.graph import connected_components
from cartoscope.operators.spatial import across_sections, proximity_pairs


def point_groups(points: DataFrame, pair_distance: float = 30) -> DataFrame:
    """points with group_id: the smallest id of the points that chains of close pairs reach (itself alone)."""
    comps = connected_components(proximity_pairs(points, pair_distance), "a", "b")
    rows = points.join(comps, F.col("id") == F.col("node"), "left")
    return rows.select(*points.columns, F.coalesce("component", "id").alias("group_id"))


def group_categories(grouped: DataFrame, name: str = "name") -> DataFrame:
    """Each group's size and sorted list of categories."""
    return grouped.groupBy("group_id").agg(F.sort_array(F.collect_list(name)).alias("names"), F.count("*").alias("size"))


def follows_rule(names: Column, include: Sequence[str] = (), exclude: Sequence[str] = (), smallest: int | None = None, largest: int | None = None) -> Column:
    """Whether a list has all names of include, none of exclude, and a size within the bounds."""
    ok = F.lit(True)
    for n in include:
        ok = ok & F.array_contains(names, n)
    for n in exclude:
        ok = ok & ~F.array_contains(names, n)
    if smallest is not None:
        ok = ok & (F.size(names) >= smallest)
    return ok & (F.size(names) <= largest) if largest is not None else ok


def apply_rules(groups: DataFrame, rules: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """groups with rule: the first rule that its names follow, else null."""
    out = F.lit(None).cast("string")
    for name, rule in reversed(list(rules.items())):
        out = F.when(follows_rule(F.col("names"), **rule), name).otherwise(out)
    return groups.withColumn("rule", out)


def agreement(groups: DataFrame, positive: tuple[str, str], negative: tuple[str, str]) -> DataFrame:
    """How two annotators agree in each group: agree_positive, agree_negative, disagree, single or none."""
    has = [(F.array_contains("names", p), F.array_contains("names", n)) for p, n in zip(positive, negative, strict=True)]
    (p1, n1), (p2, n2) = has
    verdict = F.when((p1 & n2) | (n1 & p2), "disagree").when(p1 & p2, "agree_positive").when(n1 & n2, "agree_negative").when(p1 | n1 | p2 | n2, "single").otherwise("none")
    return groups.withColumn("agreement", verdict)


def cupn(grouped: DataFrame, is_c: Column, is_u: Column, is_p: Column, is_n: Column) -> DataFrame:
    """Numbers of groups by their counts of computer-sure, unsure, human-positive and human-negative points."""
    each = grouped.groupBy("group_id").agg(*[F.count_if(c).alias(k) for k, c in zip("cupn", (is_c, is_u, is_p, is_n), strict=True)])
    return each.groupBy(*"cupn").agg(F.count("*").alias("n_groups"))


def dedupe(points: DataFrame, pair_distance: float = 30) -> DataFrame:
    """Points without duplicates: the smallest id of each group within a section, then without those near a kept point of the section before."""
    kept = point_groups(points, pair_distance).where("id = group_id").drop("group_id")
    kept = durable(kept, "dedupe")
    later = across_sections(kept, pair_distance).select(F.col("b").alias("id")).distinct()
    return kept.join(later, "id", "left_anti")


def best_threshold(grouped: DataFrame) -> DataFrame:
    """In each group the rows of the threshold with the highest mean score; in groups of sure and unsure rows only sure ones compete.

    grouped: group_id, id, threshold, kind (sure or unsure), mean_score. Ties: the smaller threshold.
    """
    w = W.partitionBy("group_id")
    rows = grouped.withColumn("has_sure", F.max(F.col("kind") == "sure").over(w)).where(~F.col("has_sure") | (F.col("kind") == "sure"))
    best = rows.groupBy("group_id").agg(F.max(F.struct("mean_score", (-F.col("threshold")).alias("t"))).alias("m"))
    best = best.select("group_id", (-F.col("m.t")).alias("threshold"))
    return rows.join(best, ["group_id", "threshold"], "left_semi").drop("has_sure")


def consecutive_runs(points: DataFrame, pair_distance: float = 30) -> DataFrame:
    """How many cells span exactly k consecutive sections, k >= 2: chains of points linked from section to section."""
    edges = across_sections(points, pair_distance)
    comps = connected_components(edges, "a", "b").withColumnRenamed("node", "id")
    spans = comps.join(points.select("id", "section"), "id").groupBy("component").agg((F.max("section") - F.min("section") + 1).alias("n_sections"))
    return spans.groupBy("n_sections").agg(F.count("*").alias("n_cells"))


#: Pairs of a component that one task settles in sorted order; larger components take rounds.
COMPONENT_PAIRS = 1_000_000


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of pairs sorted by component, distance and ids, those whose both ends are free when their turn comes."""
    now, ends_a, ends_b = None, set(), set()
    for batch in batches:
        keep = np.zeros(len(batch), bool)
        for i, (comp, a, b) in enumerate(zip(*(batch[c].tolist() for c in ("comp", "a", "b")), strict=True)):
            if comp != now:
                now, ends_a, ends_b = comp, set(), set()
            if a not in ends_a and b not in ends_b:
                ends_a.add(a)
                ends_b.add(b)
                keep[i] = True
        yield batch.loc[keep, ["a", "b", "dist"]]


def greedy_match(pairs: DataFrame, truth: str = "a", prediction: str = "b", dist: str = "d2", most: int = COMPONENT_PAIRS) -> DataFrame:
    """One-to-one matching by ascending distance (ties by ids): (truth, prediction, dist) of the pairs taken.

    Pairs only compete within a connected component of the graph of pairs. A component of one pair is taken as it is; others
    are settled in sorted order, many in one task. Components of more than most pairs take rounds, each
    of all pairs that are best on both sides, which can never lose to an earlier one. Pairs with a null id or distance match nothing.
    Repeated pairs count once, at their smallest distance. Ids are integers or strings.
    """
    named = pairs.select(F.col(truth).alias("a"), F.col(prediction).alias("b"), F.col(dist).alias("dist")).where("a is not null and b is not null and dist is not null")
    each = durable(named.groupBy("a", "b").agg(F.min("dist").alias("dist")), "match")
    node = lambda side: F.concat(F.lit(side), F.col(side).cast("string"))
    comps = durable(connected_components(each.select(node("a").alias("src"), node("b").alias("dst"))), "comps")
    of_truth = comps.where("node like 'a%'").select(F.substring("node", 2, 1 << 30).cast(each.schema["a"].dataType).alias("a"), F.col("component").alias("comp"))
    each_of = durable(each.join(of_truth, "a"), "match")
    sizes = durable(each_of.groupBy("comp").agg(F.count("*").alias("n")), "sizes")
    release(comps)
    release(each)
    rows = each_of.join(sizes, "comp")
    alone = rows.where("n = 1").select("a", "b", "dist")
    kinds = ", ".join(f"{c} {each.schema[c].dataType.simpleString()}" for c in ("a", "b", "dist"))
    some = rows.where((F.col("n") > 1) & (F.col("n") <= most)).repartition("comp").sortWithinPartitions("comp", "dist", "a", "b")
    out = [durable(alone.unionByName(some.select("comp", "a", "b", "dist").mapInPandas(_settled, kinds)), "took")]
    large = sizes.where(F.col("n") > most)
    if not large.isEmpty():
        out += _rounds(rows.where(F.col("n") > most).select("a", "b", "dist"))
    release(each_of)
    release(sizes)
    return together(out).select(F.col("a").alias(truth), F.col("b").alias(prediction), F.col("dist").alias(dist))


def _rounds(pairs: DataFrame) -> list[DataFrame]:
    """Durable tables of the pairs (a, b, dist) that each round takes."""
    order = F.struct("dist", "a", "b")
    left, out = durable(pairs, "match"), []
    while not left.isEmpty():
        best = left.groupBy("a").agg(F.min(order).alias("m")).select("m.*")
        top = left.groupBy("b").agg(F.min(order).alias("m")).select("m.*")
        out.append(durable(best.join(top, ["dist", "a", "b"]).select("a", "b", "dist"), "took"))
        rest = left.join(out[-1].select("a"), "a", "left_anti").join(out[-1].select("b"), "b", "left_anti")
        after = durable(rest.select("a", "b", "dist"), "match")
        release(left)
        left = after
    release(left)
    return out


def closure(tree: DataFrame) -> DataFrame:
    """Rows (ancestor, id, depth): every node under each of its ancestors and itself (depth 0), by doubling joins.

    A node that lies on a cycle or behind one is a ValueError: it would be its own ancestor without end. A tree
    of n nodes is no deeper than n, so the doubling stops there.
    """
    up = tree.where("parent_id is not null").select("id", F.col("parent_id").alias("ancestor"), F.lit(1).alias("depth"))
    tables, step = [durable(up, "closure")], 1
    most = tables[0].count()
    while True:
        out = together(tables)
        far = out.where(F.col("depth") == step).select(F.col("id").alias("ancestor"), F.col("ancestor").alias("__up"))
        more = out.join(far, "ancestor").select("id", F.col("__up").alias("ancestor"), (F.col("depth") + step).alias("depth"))
        reach = durable(more, "closure")
        if reach.isEmpty():
            break
        tables.append(reach)
        step *= 2
        if step > most or not reach.where("id = ancestor").isEmpty():
            raise ValueError("the parents run in a circle")
    own = tree.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth"))
    return together(tables).unionByName(own).select("ancestor", "id", "depth")


def rollup(tree: DataFrame, counts: DataFrame, value: str = "n") -> DataFrame:
    """Each node's total over itself and all descendants; 0 where there is none.

    Sums move up one level in each round, combined at every parent, so a round carries as many rows as there
    are nodes with something to pass on, and no table of all ancestors is made. Nodes on a cycle are a ValueError.
    """
    parents = durable(tree.select("id", "parent_id"), "tree")
    now = durable(counts.groupBy("id").agg(F.sum(value).cast("long").alias("total")).join(parents.select("id"), "id", "left_semi"), "sums")
    sums, most = [now], parents.count()
    while True:
        if len(sums) > most + 1:
            raise ValueError("the parents run in a circle")
        up = now.join(parents.where("parent_id is not null"), "id").groupBy(F.col("parent_id").alias("id")).agg(F.sum("total").alias("total"))
        now = durable(up, "sums")
        if now.isEmpty():
            break
        sums.append(now)
    total = together(sums).groupBy("id").agg(F.sum("total").alias("total"))
    return parents.select("id").join(total, "id", "left").select("id", F.coalesce("total", F.lit(0)).cast("long").alias("total"))


def within_levels(tree: DataFrame, node: str, levels: int) -> DataFrame:
    """Descendants of a node that are at most so many levels below it."""
    return closure(tree).where((F.col("ancestor") == node) & F.col("depth").between(1, levels)).select("id", "depth")


def prune_leaves(tree: DataFrame, present: DataFrame) -> DataFrame:
    """The tree without leaves whose id is not present."""
    inner = tree.where("parent_id is not null").select(F.col("parent_id").alias("id")).distinct()
    keep = inner.unionByName(present.select("id")).distinct()
    return tree.join(keep, "id", "left_semi")
