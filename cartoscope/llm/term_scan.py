"""Ranked lexical search by an Aho-Corasick scan of the documents.

The items' terms, each between two guards, become one automaton. A document's words stand between guards too,
so the automaton's hits are whole words, and neighbouring words share a guard. Term frequencies are counted while
the text is read; no index of the documents is made. The scan writes one small row a document (its number of
words, the item terms in it and how often they occur). Document frequencies, the number of documents and of words are
aggregates of these rows. A second pass over the same rows maps terms to the items that have them, adds up the integer
scores of a batch, and keeps the best documents of each item in the task; the best of all tasks are ranked by a window.

Items are taken in blocks of about BLOCK_CHARS characters, so the automaton and the table from terms to items that are
broadcast have a bound; more items take more scans. An item's own text is the one thing that must fit in a task.

Defined results: null and empty texts have no terms; documents without terms count in no statistic. Items without
terms, or whose terms no document has, have no row. Repeated document rows, and rows with a null id, each rank for
themselves; a null id stands behind all others of an equal score. Items of the same id are one item with the terms of
all their texts. Texts of any length are read whole, with extra columns ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release, together
from cartoscope.llm.text_hash import LOWER, SEPARATORS, chunks
from cartoscope.llm.winnowing import words_of

#: Characters of items whose terms are looked for in one scan.
BLOCK_CHARS = 2_000_000
#: Entries (document, term, item), and sums (document, item), that a task holds at a time; one document is held whole.
ENTRIES = 2_000_000
#: Text bytes as the automaton reads them: lower case, and one guard for all that parts words.
GUARD = b" "
READ_AS = np.where(SEPARATORS, np.uint8(GUARD[0]), LOWER)


def automaton(terms: list[str]):
    """Automaton of guarded terms; a hit gives the term's number. Text and terms are UTF-8 bytes, one character each."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word((GUARD + term.encode() + GUARD).decode("latin-1"), number)
    found.make_automaton()
    return found


def _scanned(shared: Broadcast):
    """Rows (doc, text) to (doc, n, terms, tfs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        hit = np.dtype([("end", np.int64), ("term", np.int32)])
        for batch in batches:
            for texts, i, j in chunks(batch, lower=False, spaces=SEPARATORS):
                rows = j - i
                # a guard before each text and behind the last one
                guarded = np.insert(READ_AS[texts.data], np.r_[texts.offsets[:-1], len(texts.data)], GUARD[0])
                heads = texts.offsets + np.arange(rows + 1)
                n = np.diff(texts.at)
                hits = np.fromiter(search.iter(guarded.tobytes().decode("latin-1")), hit)
                row = np.searchsorted(heads, hits["end"] - 1, "right") - 1
                key, tf = np.unique(row << 32 | hits["term"], return_counts=True)
                offs = pa.array(np.searchsorted(key, np.arange(rows + 1) << 32).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offs, pa.array(x)) for x in ((key & 0xFFFFFFFF).astype(np.int32), tf.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(n.astype(np.int64)), *lists], ["doc", "n", "terms", "tfs"])

    return run


def term_scores(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, docs: int, words: int) -> np.ndarray:
    """Score of a term in a document: 64-bit integers, divisions rounded down."""
    m = 100 - 90 + (90 * n * docs) // max(1, words)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Best:
    """The k best documents of each of the items 0, 1, ... so far: highest scores first, equal ones by ascending id, null ids last."""

    def __init__(self, k: int, items: int):
        self.k, self.items, self.bound = k, items, np.ones(items, np.int64)
        self.item, self.score, self.doc, self.null = *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)

    def add(self, total: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """total: scores of further documents, a row each. A score below the bound of its item has k others above it."""
        if len(total) > self.k:
            self.bound = np.maximum(self.bound, np.partition(total, -self.k, axis=0)[-self.k])
        row, item = np.nonzero(total >= self.bound)
        found = zip((self.item, self.score, self.doc, self.null), (item, total[row, item], doc[row], null[row]), strict=True)
        item, score, doc, null = (np.concatenate(x) for x in found)
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item = order[place < self.k], item[place < self.k]
        self.item, self.score, self.doc, self.null = item, score[order], doc[order], null[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.bound[item[last]] = np.maximum(self.bound[item[last]], self.score[last])


#: Sums of scores are made of two halves, each of which is exact as a double.
HALF = 20


def _summed(key: np.ndarray, value: np.ndarray, cells: int) -> np.ndarray:
    high, low = (np.bincount(key, v, cells).astype(np.int64) for v in (value >> HALF, value & ((1 << HALF) - 1)))
    return (high << HALF) + low


def _ranked(shared: Broadcast, docs: int, words: int, k: int):
    """Rows (doc, n, terms, tfs) to the k best documents of each item in the task: (item, doc, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, items = shared.value  # of term t: weight[t], items[first[t]:first[t + 1]]
        width = int(items.max(initial=-1)) + 1
        best = Best(k, width)
        for batch in batches:
            ids = batch.column(0)
            doc, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            terms, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            row = np.repeat(np.arange(len(doc)), sizes)
            each = term_scores(tf, n[row], weight[terms], docs, words)
            fan = first[terms + 1] - first[terms]
            head = np.r_[0, np.cumsum(sizes)]
            upto = np.r_[0, np.cumsum(fan)][head]  # entries before each row
            a = 0
            while a < len(doc):
                b = min(int(np.searchsorted(upto, upto[a] + ENTRIES, "right")) - 1, a + ENTRIES // width)
                b = min(max(a + 1, b), len(doc))
                some = slice(head[a], head[b])
                f = fan[some]
                at = np.arange(f.sum()) + np.repeat(first[terms[some]] - (np.cumsum(f) - f), f)
                total = _summed(np.repeat((row[some] - a) * width, f) + items[at], np.repeat(each[some], f), (b - a) * width)
                best.add(total.reshape(b - a, width), doc[a:b], null[a:b])
                a = b
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc, mask=best.null), pa.array(best.score)], ["item", "doc", "score"])

    return run


def _blocks(items: DataFrame) -> list[DataFrame]:
    """The rows (item, text), dealt by their id into parts of about BLOCK_CHARS characters."""
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = -(-size // BLOCK_CHARS)
    return [items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == p) for p in range(parts)]


def _block(rows: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """A durable table (id, rank, doc, score) of one block of items; None if it has no terms."""
    context = rows.sparkSession.sparkContext
    # each (item, term) once; bounded by the block
    pairs = items.select("item", F.explode(words_of(F.col("text"))).alias("term")).distinct().collect()
    if not pairs:
        return None
    terms = {t: i for i, t in enumerate(sorted({r["term"] for r in pairs}))}
    ids = {x: i for i, x in enumerate(dict.fromkeys(r["item"] for r in pairs))}
    search = context.broadcast(automaton(list(terms)))
    read = durable(rows.mapInArrow(_scanned(search), "doc long, n long, terms array<int>, tfs array<long>").where("n > 0"), "scan")
    docs, words = read.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in read.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # at most the block's terms
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    links = np.array(sorted((terms[r["term"]], ids[r["item"]]) for r in pairs), np.int64).reshape(-1, 2)
    first = np.searchsorted(links[:, 0], np.arange(len(terms) + 1))
    table = context.broadcast((weight, first, links[:, 1].copy()))
    some = read.where(F.size("terms") > 0).mapInArrow(_ranked(table, docs, words, k), "item long, doc long, score long")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    top = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = rows.sparkSession.createDataFrame([(i, x) for x, i in ids.items()], f"item long, id {items.schema['item'].dataType.simpleString()}")
    out = durable(top.join(names, "item").select("id", "rank", "doc", "score"), "ranked")
    release(read)
    search.unpersist()
    table.unpersist()
    return out


def search(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 10) -> DataFrame:
    """Rows (item_col, rank, id_col, score): the k documents of the highest score above 0 for each item, from rank 1.

    The score of a document is the sum over an item's distinct terms of an inverse-document-frequency weight times a saturated,
    length-normalised term frequency, in 64-bit integers.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    parts = [p for p in (_block(rows, block, k) for block in _blocks(wanted)) if p is not None]
    none = wanted.limit(0).select(F.col("item").alias("id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc"), F.lit(0).cast("long").alias("score"))
    out = together(parts) if parts else none
    return out.select(F.col("id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
