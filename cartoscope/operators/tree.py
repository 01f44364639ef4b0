"""Interval numbering of a tree of regions: the descendants of a node are a range of numbers, without a table of all ancestors.

Nodes are numbered in the order of a tour from the root through the children of each node. The tour is a linked list: a step
down into a node is followed by its first child or, behind the last one, by the step up, which is followed by
the next sibling or the parent's step up. Each list element's distance from the end is found by doubling pointers, so the
rounds follow the logarithm of the number of nodes and not the depth. Leaves, most of a tree, need not walk the tour:
they take numbers side by side at the end of their parent's range.

Siblings are chained in salted parts, so a node with a third of all nodes as its children is no single task.

Defined results: a node whose parent is null or not in the table is a root; a forest is numbered root by root. Rows with a null id are left
out. Repeated ids, and parents that run in a circle, are a ValueError. An empty tree has no numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release

#: Parts in which the children of a node are chained, or counted.
SALTS = 64
#: Numbers of a block whose running sums are made in one place.
BLOCK = 10_000


def _nodes(tree: DataFrame) -> DataFrame:
    """A durable table (id, parent, inner): inner nodes have children; parent is null for roots."""
    rows = tree.where("id is not null").select("id", F.col("parent_id").alias("parent"))
    known = rows.select(F.col("id").alias("parent")).distinct()
    up = rows.where("parent is not null").join(known, "parent", "left_semi").select("id", "parent")
    parents = up.select(F.col("parent").alias("id"), F.lit(True).alias("inner")).distinct()
    one = rows.select("id").join(up, "id", "left").join(parents, "id", "left")
    out = durable(one.select("id", "parent", F.coalesce("inner", F.lit(False)).alias("inner")), "nodes")
    n, distinct = out.agg(F.count("*"), F.count_distinct("id")).first()
    if n > distinct:
        raise ValueError("an id occurs more than once")
    return out


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def _chained(inner: DataFrame) -> DataFrame:
    """Rows (parent, id, next, head) of the inner nodes: each one's next sibling, and whether it is its parent's first."""
    part = W.partitionBy("parent", "salt").orderBy("id")
    each = inner.withColumn("salt", _salt("id")).withColumns({"next": F.lead("id").over(part), "place": F.row_number().over(part)})
    heads = each.where("place = 1").select("parent", "salt", "id")
    parts = W.partitionBy("parent").orderBy("salt")  # at most SALTS rows a parent
    heads = heads.withColumns({"after": F.lead("id").over(parts), "turn": F.row_number().over(parts)}).select(F.col("parent").alias("p"), F.col("salt").alias("s"), "after", "turn")
    rows = each.join(heads, each["parent"].eqNullSafe(F.col("p")) & (each["salt"] == F.col("s")))
    return rows.select("parent", "id", F.coalesce("next", "after").alias("next"), ((F.col("place") == 1) & (F.col("turn") == 1)).alias("head"))


def _ranked(arcs: DataFrame) -> DataFrame:
    """A durable table (arc, n, d): sums of n and d from each arc (arc, next, n, d) to the end of the list, by pointer doubling."""
    now = durable(arcs, "tour")
    rounds, most = 0, now.count()
    while not now.where("next is not null").isEmpty():
        if 1 << rounds > most:
            raise ValueError("the parents run in a circle")
        ahead = now.select(F.col("arc").alias("next"), F.col("next").alias("then"), F.col("n").alias("n2"), F.col("d").alias("d2"))
        step = now.join(ahead, "next", "left").select("arc", F.col("then").alias("next"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"))
        after = durable(step, "tour")
        release(now)
        now, rounds = after, rounds + 1
    return now


def intervals(tree: DataFrame) -> DataFrame:
    """A durable table (id, first, last, depth) of a tree (id, parent_id): a node's descendants and itself are the numbers first to last.

    Numbers run from 0 without gaps; roots have depth 0.
    """
    nodes = _nodes(tree)
    down, up = (lambda c, k=k: F.struct(c.alias("id"), F.lit(k).alias("up")) for k in (0, 1))
    inner = nodes.where("inner or parent is null")  # roots walk the tour, with or without children
    chain = durable(_chained(inner.select("id", "parent")), "chain")
    leaves = nodes.where("not inner and parent is not null").select("id", "parent")
    counted = leaves.groupBy("parent", _salt("id").alias("salt")).agg(F.count("*").alias("leaves"))
    own = counted.groupBy(F.col("parent").alias("id")).agg(F.sum("leaves").alias("leaves"))
    first = chain.where("head and parent is not null").select(F.col("parent").alias("id"), F.col("id").alias("child"))
    enter = chain.select("id").join(first, "id", "left").select(down(F.col("id")).alias("arc"), F.when(F.col("child").isNotNull(), down(F.col("child"))).otherwise(up(F.col("id"))).alias("next"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("d"))
    behind = F.when(F.col("next").isNotNull(), down(F.col("next"))).when(F.col("parent").isNotNull(), up(F.col("parent")))
    leave = chain.join(own, "id", "left").select(up(F.col("id")).alias("arc"), behind.alias("next"), F.coalesce("leaves", F.lit(0)).cast("long").alias("n"), F.lit(-1).cast("long").alias("d"))
    ranked = _ranked(enter.unionAll(leave))
    total = nodes.count()
    # nodes on a circle hang on no root: their tour has no end, which _ranked finds, unless nothing but the circle is there
    ends = ranked.groupBy("arc.id").agg(F.max(F.when(F.col("arc.up") == 0, F.col("n"))).alias("a"), F.max(F.when(F.col("arc.up") == 0, F.col("d"))).alias("d"), F.max(F.when(F.col("arc.up") == 1, F.col("n"))).alias("b"))
    # an inner node's leaves stand at the end of its range: from b on they are its own
    walked = ends.join(own, "id", "left").select("id", (F.lit(total) - F.col("a")).alias("first"), (F.lit(total) - F.col("b") + F.coalesce("leaves", F.lit(0)) - 1).alias("last"), (-F.col("d")).alias("depth"), F.coalesce("leaves", F.lit(0)).alias("leaves"))
    walked = durable(walked, "walked")
    ahead = counted.withColumn("ahead", F.coalesce(F.sum("leaves").over(W.partitionBy("parent").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select(F.col("parent").alias("p"), F.col("salt").alias("s"), "ahead")
    place = leaves.withColumn("salt", _salt("id")).withColumn("place", F.row_number().over(W.partitionBy("parent", "salt").orderBy("id")) - 1)
    place = place.join(ahead, (F.col("parent") == F.col("p")) & (F.col("salt") == F.col("s"))).select(F.col("id").alias("leaf"), F.col("parent").alias("id"), (F.col("ahead") + F.col("place")).alias("at"))
    number = F.col("last") - F.col("leaves") + 1 + F.col("at")
    low = place.join(walked, "id").select(F.col("leaf").alias("id"), number.alias("first"), number.alias("last"), (F.col("depth") + 1).alias("depth"))
    out = walked.select("id", "first", "last", "depth").unionAll(low).select("id", *[F.col(c).cast("long").alias(c) for c in ("first", "last")], F.col("depth").cast("int").alias("depth"))
    out = durable(out, "intervals")
    for old in (nodes, chain, ranked, walked):
        release(old)
    return out


def within_levels(numbered: DataFrame, node: object, levels: int) -> DataFrame:
    """Rows (id, depth) of the descendants of a node at most so many levels below it, of a numbered tree: a range of one column."""
    top = numbered.where(F.col("id") == F.lit(node)).select("first", "last", "depth").first()  # one row
    if top is None:
        return numbered.limit(0).select("id", "depth")
    under = numbered.where((F.col("first") > top["first"]) & (F.col("first") <= top["last"]) & (F.col("depth") <= top["depth"] + levels))
    return under.select("id", (F.col("depth") - top["depth"]).alias("depth"))


def prefix_sums(rows: DataFrame, number: str, columns: Sequence[str]) -> DataFrame:
    """rows with upto_<column>: the sum over all rows of a number up to it. Blocks of BLOCK numbers are summed in one place each, and one total a block in order."""
    each = rows.withColumn("__b", F.floor(F.col(number) / BLOCK))
    inside = W.partitionBy("__b").orderBy(number).rangeBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    totals = each.groupBy("__b").agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(columns)])
    totals = totals.select("__b", *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__t{i}") for i in range(len(columns))])
    out = each.withColumns({f"__u{i}": F.sum(c).over(inside) for i, c in enumerate(columns)}).join(totals, "__b")
    return out.select(*rows.columns, *[(F.col(f"__u{i}") + F.col(f"__t{i}")).alias(f"upto_{c}") for i, c in enumerate(columns)])


def subtree_sums(numbered: DataFrame, values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (id, columns): the sums of each node of a numbered tree over itself and all its descendants, 0 where there is nothing.

    values: (id, columns), several rows a node or none; ids that the tree lacks count nowhere. A range's sum is the difference of two running sums.
    """
    own = values.groupBy("id").agg(*[F.sum(c).alias(c) for c in columns])
    placed = numbered.select("id", "first", "last").join(own, "id", "left").select("id", "first", "last", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
    upto = durable(prefix_sums(placed, "first", columns), "upto")
    ends = upto.select(F.col("first").alias("last"), *[F.col(f"upto_{c}").alias(f"end_{c}") for c in columns])
    out = upto.join(ends, "last")
    return out.select("id", *[(F.col(f"end_{c}") - F.col(f"upto_{c}") + F.col(c)).alias(c) for c in columns])


def nearest_chosen(tree: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows (id, chosen): the nearest chosen ancestor of each node of a tree (id, parent_id), itself included; null without one.

    Each node points to its parent, or to itself if it is chosen, and pointers are doubled: rounds follow the logarithm of the depth, and a
    round has a row a node.
    """
    rows = tree.where("id is not null").select("id", F.col("parent_id").alias("to"))
    mark = chosen.select("id", F.lit(True).alias("done")).distinct()
    now = durable(rows.join(mark, "id", "left").select("id", F.when(F.col("done"), F.col("id")).otherwise(F.col("to")).alias("to"), F.coalesce("done", F.lit(False)).alias("done")), "near")
    rounds, most = 0, now.count()
    while not now.where("not done and to is not null").isEmpty():
        if 1 << rounds > 2 * most:
            raise ValueError("the parents run in a circle")
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("done").alias("end"))
        open_ = now.where("not done and to is not null").join(ahead, "to", "left").select("id", F.col("then").alias("to"), F.coalesce("end", F.lit(False)).alias("done"))
        after = durable(now.where("done or to is null").unionByName(open_), "near")
        release(now)
        now, rounds = after, rounds + 1
    return now.select("id", F.when(F.col("done"), F.col("to")).alias("chosen"))


def hemisphere_centres(voxels: DataFrame, tree: DataFrame, asked: DataFrame, middle: int, resolution: float) -> DataFrame:
    """Rows (structure, side, z, y, x, n): centre of mass of each asked structure (structure, side) with all its descendants.

    Side L takes the voxels (structure, z, y, x) below the middle plane of x, R those from it on, anything else all of them. Centres are in the volume's
    own coordinates times the resolution, on the right side too; null where there is no voxel.
    """
    right = F.col("x") >= middle
    part = {f"{c}{k}": F.when(right if k else ~right, F.lit(1) if c == "n" else F.col(c)).otherwise(0).cast("long") for k in (0, 1) for c in "nzyx"}
    values = voxels.groupBy(F.col("structure").alias("id")).agg(*[F.sum(v).alias(k) for k, v in part.items()])
    sums = subtree_sums(intervals(tree), values, list(part))
    rows = asked.join(sums, asked["structure"] == sums["id"])
    total = {c: F.when(F.col("side") == "L", F.col(f"{c}0")).when(F.col("side") == "R", F.col(f"{c}1")).otherwise(F.col(f"{c}0") + F.col(f"{c}1")) for c in "nzyx"}
    return rows.select("structure", "side", *[(total[c] / F.nullif(total["n"], F.lit(0)) * resolution).alias(c) for c in "zyx"], total["n"].alias("n"))
