"""Correlation and edge energy of candidate windows with a mean-image template.

A window is a small image around a candidate. Its pixels are brought together once, by a shuffle on the window, as
one array in line order; gradients, normalisation and products are array expressions of that row. A gradient is
separable: a derivative of five pixels along one axis and a smoothing of five along the other, with the image mirrored
at its edge pixels. Windows and template are trimmed to their common size around the middle first, so a template's
gradients are made once for each size that occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release

#: Weights of the five pixels from the second before to the second behind.
DERIVATIVE, SMOOTHING = (-1, -2, 0, 2, 1), (1, 4, 6, 4, 1)
#: Pixels of one window at most; larger images are not candidate windows.
WINDOW_PIXELS = 1 << 20
#: Pixels of all trimmed templates that may be broadcast.
TEMPLATE_PIXELS = 1 << 20
#: Added to a spread before it divides.
LEAST = 1e-8


def windows(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, h, w, v): each window's height, width and values in line order.

    A window with a missing, null or repeated pixel has a null v. One of more than WINDOW_PIXELS is a ValueError, found before anything is gathered.
    """
    ends = [f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))]
    h, w = (F.col("hi_row") - F.col("lo_row") + 1).cast("int"), (F.col("hi_col") - F.col("lo_col") + 1).cast("int")
    most = pixels.groupBy(*keys).agg(*ends, F.count("*").alias("n")).agg(F.max(F.greatest(h * w, F.col("n")))).first()[0] or 0
    if most > WINDOW_PIXELS:
        raise ValueError(f"a window of {most} pixels, more than {WINDOW_PIXELS}")
    cells = F.sort_array(F.collect_list(F.struct("row", "col", F.col("value").cast("double").alias("value"))))
    rows = pixels.groupBy(*keys).agg(*ends, F.count_distinct("row", "col").alias("n"), F.count("value").alias("m"), F.count("*").alias("all"), cells.alias("cells"))
    whole = (F.col("n") == h * w) & (F.col("m") == F.col("n")) & (F.col("all") == F.col("n"))
    return rows.select(*keys, h.alias("h"), w.alias("w"), F.when(whole, F.col("cells.value")).alias("v"))


def trimmed(rows: DataFrame, height: str, width: str) -> DataFrame:
    """rows (..., h, w, v) cut to no more than the given columns' sizes, as far as possible around the middle."""
    rows = rows.withColumns({"__h": F.least("h", height).cast("int"), "__w": F.least("w", width).cast("int")})
    rows = rows.withColumns({"__r": F.expr("(h - __h) div 2"), "__c": F.expr("(w - __w) div 2")})
    cut = F.expr("transform(sequence(0L, cast(__h as long) * __w - 1), i -> get(v, cast((i div __w + __r) * w + i % __w + __c as int)))")
    return rows.withColumn("__v", F.when(F.col("v").isNotNull(), cut)).drop("h", "w", "v", "__r", "__c", height, width).withColumnsRenamed({"__h": "h", "__w": "w", "__v": "v"})


def _filtered(array: str, weights: Sequence[int], along: str) -> Column:
    """Weighted sum of five pixels along an axis at each pixel of an image (h, w, array), mirrored at the edges."""
    terms = []
    for k, weight in zip(range(-2, 3), weights, strict=True):
        at, n = ("i % w", "w") if along == "col" else ("i div w", "h")
        # places run 0, 1, ..., n - 1, n - 2, ..., 1 and again from 0
        place = f"(({n} - 1) - abs(({n} - 1) - pmod({at} + ({k}), greatest(2 * ({n} - 1), 1))))"
        index = f"(i div w) * w + {place}" if along == "col" else f"{place} * w + i % w"
        if weight:
            terms.append(f"{weight} * get({array}, cast({index} as int))")
    return F.when(F.col(array).isNotNull(), F.expr(f"transform(sequence(0L, cast(h as long) * w - 1), i -> {' + '.join(terms)})"))


def _mean(array: str, of: str = "x") -> Column:
    return F.expr(f"aggregate({array}, 0D, (a, x) -> a + {of}) / size({array})")


def gradients(rows: DataFrame) -> DataFrame:
    """rows (..., h, w, v) with gx and gy: 5 x 5 gradients of each window, less their mean and divided by their spread over both axes."""
    rows = rows.withColumns({"__d": _filtered("v", DERIVATIVE, "col"), "__s": _filtered("v", SMOOTHING, "col")})
    rows = rows.withColumns({"__x": _filtered("__d", SMOOTHING, "row"), "__y": _filtered("__s", DERIVATIVE, "row")})
    rows = rows.withColumns({"__mx": _mean("__x"), "__my": _mean("__y")})
    rows = rows.withColumns({"__vx": _mean("__x", "(x - __mx) * (x - __mx)"), "__vy": _mean("__y", "(x - __my) * (x - __my)")})
    rows = rows.withColumns({"__m": F.expr("(__mx + __my) / 2"), "__t": F.sqrt(F.expr("(__vx + __vy) / 2")) + LEAST})
    rows = rows.withColumns({f"g{c}": F.expr(f"transform(__{c}, x -> (x - __m) / __t)") for c in "xy"})
    return rows.drop("__d", "__s", "__x", "__y", "__mx", "__my", "__vx", "__vy", "__m", "__t")


def correlation_energy(pixels: DataFrame, template: DataFrame, keys: Sequence[str] = ("id",), channel: str = "channel") -> DataFrame:
    """Rows (keys, channel, corr, energy) of every candidate window (keys, channel, row, col, value).

    corr: mean product of the window's normalised gradients with the template's (channel, row, col, value). energy: mean of
    the gradients' magnitude times the template. Both are null for a window that is no full rectangle or whose
    channel has no template.
    """
    found = windows(pixels, [*keys, channel])
    # two templates of a channel would be two answers, so a channel is one window
    masks = durable(windows(template, [channel]), "template")
    sizes = masks.select(channel, F.col("h").alias("th"), F.col("w").alias("tw"))
    few = (masks.agg(F.sum(F.col("h").cast("long") * F.col("w"))).first()[0] or 0) <= TEMPLATE_PIXELS
    found = durable(gradients(trimmed(found.join(F.broadcast(sizes) if few else sizes, channel, "left").withColumns({"th": F.coalesce("th", "h"), "tw": F.coalesce("tw", "w")}), "th", "tw")), "windows")
    used = found.select(channel, F.col("h").alias("th"), F.col("w").alias("tw")).distinct()
    cut = gradients(trimmed(masks.join(used, channel), "th", "tw")).withColumnsRenamed({"v": "tv", "gx": "tx", "gy": "ty"})
    cut = durable(cut, "trimmed")
    small = (cut.agg(F.sum(F.col("h").cast("long") * F.col("w"))).first()[0] or 0) <= TEMPLATE_PIXELS
    both = found.join(F.broadcast(cut) if small else cut, [channel, "h", "w"], "left")
    each = F.expr("transform(gx, (x, i) -> x * get(tx, i) + get(gy, i) * get(ty, i))")
    strong = F.expr("transform(gx, (x, i) -> sqrt(x * x + get(gy, i) * get(gy, i)) * get(tv, i))")
    rows = both.withColumns({"__c": each, "__e": strong})
    out = durable(rows.select(*keys, channel, _mean("__c").alias("corr"), _mean("__e").alias("energy")), "corr")
    for old in (masks, found, cut):
        release(old)
    return out
