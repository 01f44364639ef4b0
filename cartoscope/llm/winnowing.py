"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's words are hashed, every k consecutive words to one hash, and of each sliding window of words the
smallest of these hashes is kept as its fingerprint. Equal windows keep equal fingerprints, so every span that a
document shares with a benchmark item over at least one window of words brings them together; nothing is
sampled. A document's kept fingerprints are first held against a bit table of the items' fingerprints, inside the
row. Those that pass are joined to the items' windows by fingerprint, and a hit is extended to all windows whose
smallest hash it is, each compared word by word: the join's key is the fingerprint and the window's words.

The document is read once. Its row keeps the number of words and the windows that passed the bit table; a large
text stays in its row, and only windows that passed become rows of their own. The items' windows are broadcast
while they are few (BROADCAST_WINDOWS, BROADCAST_CHARS), else both sides are shuffled by window.

Defined results: null and empty texts, and texts without words, have n_words 0 and no hit. An item without words
has no window; one of fewer words than a window is one window as a whole. Rows with a null id, and repeated
rows, each give a row of their own. Items of the same id count once; an item without an id hits words but is not listed. Texts of any length are read whole; extra
columns are ignored. Empty tables give an empty result, or one without hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release
from cartoscope.llm.license_scan import LOWER, UPPER

#: ASCII characters that are neither letters nor digits part words.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Windows of the items, and characters in them, that may be broadcast.
BROADCAST_WINDOWS, BROADCAST_CHARS = 200_000, 64_000_000
#: Bits of the table of fingerprints for each one of them, and at most (a power of two): beyond it more windows pass to the join.
BITS_EACH, MOST_BITS = 64, 1 << 22


def words_of(text: Column) -> Column:
    """A-Z lower-cased words of a text; none for null. A word that lower() leaves alone has no capital, and most have none."""
    parts = F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")
    return F.transform(parts, lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, UPPER, LOWER)))


def with_minima(rows: DataFrame, width: int) -> DataFrame:
    """rows (..., hashes: of each word) with fps, the fingerprint of every window of width words: the smallest hash
    of (width + 1) // 2 consecutive words in it. Shorter texts have no window.

    Each step is a column of its own: a lambda that reads its neighbours would compute an inlined array again for each of them.
    """
    k = (width + 1) // 2
    rows = rows.withColumn("grams", _heads("hashes", k, lambda h, i: F.xxhash64(h, *[F.get("hashes", i + d) for d in range(1, k)])))
    if width == k:
        return rows.withColumnRenamed("grams", "fps")
    w = width - k + 1  # k-grams of a window
    return rows.withColumn("fps", _heads("grams", w, lambda v, i: F.least(v, *[F.get("grams", i + d) for d in range(1, w)]))).drop("grams")


def _heads(name: str, width: int, of: Callable[[Column, Column], Column]) -> Column:
    """of(value, index) for each element of an array column that has width - 1 others behind it."""
    return F.transform(F.slice(name, 1, F.greatest(F.size(name) - (width - 1), F.lit(0))), of)


def _hashed(rows: DataFrame) -> DataFrame:
    """rows (..., words) with hashes: of each word."""
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def item_windows(items: DataFrame, width: int, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Rows (item, size, fp, window): every window of the items, with its number of words, fingerprint and words (joined by one space)."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col).cast("string")).alias("words")).where(F.size("words") > 0)
    rows = rows.select("item", "words", F.least(F.size("words"), F.lit(width)).alias("size"))
    rows = durable(_hashed(rows), "items")
    out = None
    for (size,) in rows.select("size").distinct().collect():  # at most width values
        some = with_minima(rows.where(F.col("size") == size), size)
        each = some.select("item", "size", "words", F.posexplode("fps").alias("at", "fp"))
        each = each.select("item", "size", "fp", F.array_join(F.slice("words", F.col("at") + 1, size), " ").alias("window"))
        out = each if out is None else out.unionAll(each)
    if out is None:
        out = rows.select("item", "size", F.lit(0).cast("long").alias("fp"), F.lit("").alias("window"))
    found = durable(out.distinct(), "windows")
    release(rows)
    return found


def _bit(fp: Column, bits: int) -> Column:
    """Place of a fingerprint in a table of so many bits (a power of two)."""
    return fp.bitwiseAND(bits - 1)


def bit_table(windows: DataFrame, size: int) -> tuple[Column, int]:
    """A constant array of longs with the bits of the fingerprints of one window size, and its number of bits (at most MOST_BITS)."""
    fps = windows.where(F.col("size") == size).select("fp").distinct()
    bits = min(MOST_BITS, max(64, 1 << (BITS_EACH * fps.count() - 1).bit_length()))
    place = _bit(F.col("fp"), bits)
    words = fps.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("bits"))
    table = ["0"] * (bits // 64)
    for word, value in words.collect():  # at most MOST_BITS / 64 rows
        table[word] = str(value)
    return F.split(F.lit(",".join(table)), ",").cast("array<bigint>"), bits


def _with_hits(rows: DataFrame, size: int, table: Column, bits: int) -> DataFrame:
    """rows with h<size>, an array of (at, size, fp, window): a text's windows of that size whose fingerprint is in the table."""

    def listed(fp: Column) -> Column:
        place = _bit(fp, bits)
        word = F.get(table, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftright", word, place.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    marked = F.transform("fps", lambda fp, at: F.when(listed(fp), F.struct(at.alias("at"), F.lit(size).alias("size"), fp.alias("fp"))))
    window = lambda x: x.withField("window", F.array_join(F.slice("words", x["at"] + 1, size), " "))
    return with_minima(rows, size).withColumn(f"h{size}", F.transform(F.array_compact(marked), window)).drop("fps")


def decontaminate(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10) -> DataFrame:
    """Rows (id_col, n_words, n_hit, items, contaminated): words of each document that lie in a window of width words of an item.

    n_hit counts the document's words inside any such window; items is the sorted list of the ids (as strings) of the
    items that have one.
    """
    windows = item_windows(items, width, id_col=item_col, text_col=item_text_col)
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    rows = documents.select(F.col(id_col).alias("id"), words_of(F.col(text_col).cast("string")).alias("words"))
    rows = _hashed(rows)
    for s in sizes:
        rows = _with_hits(rows, s, *bit_table(windows, s))
    none = F.array().cast("array<struct<at:int,size:int,fp:bigint,window:string>>")
    hits = F.concat(none, *[f"h{s}" for s in sizes])
    # the row's number is kept in the written table, so it stays the same however often that is read
    read = durable(rows.select(F.monotonically_increasing_id().alias("row"), "id", F.size("words").cast("long").alias("n_words"), hits.alias("hits")), "hits")

    keys = ["size", "fp", "window"]
    each = read.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    least = windows.agg(F.count("*"), F.coalesce(F.sum(F.length("window")), F.lit(0))).first()
    few = least[0] <= BROADCAST_WINDOWS and least[1] <= BROADCAST_CHARS
    held = lambda df: F.broadcast(df) if few else df
    equal = durable(each.join(held(windows.select(*keys).distinct()), keys, "left_semi"), "equal")
    # words that the windows of a row cover: those beyond the end of all earlier windows
    spans = equal.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("at", F.col("size")))).alias("spans"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def wider(seen: Column, span: Column) -> Column:
        end = F.greatest(seen["end"], span["at"] + span["size"])
        return F.struct(end.alias("end"), (seen["n"] + end - F.greatest(seen["end"], span["at"])).alias("n"))

    spans = spans.select("row", F.aggregate("spans", start, wider)["n"].alias("n_hit"))
    named = equal.select("row", *keys).distinct().join(held(windows), keys).select("row", "item").distinct()
    named = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = durable(spans.join(named, "row"), "found")
    release(equal)
    out = read.select("row", "id", "n_words").join(found, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def digests(found: DataFrame) -> DataFrame:
    """decontaminate()'s rows with n_items and items_sha256 (of the ids joined by commas) in place of the list."""
    joined = F.array_join("items", ",")
    return found.withColumns({"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(joined, 256)}).drop("items")
