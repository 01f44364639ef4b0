"""Substring dedup by recompression.

Rounds of recompression rename each text: maximal runs of one symbol become one symbol, then every
pair (left symbol, right symbol) becomes one, where a bit of the symbol's own name says which side
it takes. Names are hashes of what they stand for, so a name means the same in every document
without any dictionary to shuffle, and a decision looks only at neighbouring symbols: inside equal
substrings the symbols are equal, except for a few at both ends. For each window of words the
symbols that its own words determine are found, and the one with the smallest hash is its anchor;
equal windows have equal anchors at equal places. The anchor's symbol with a few words around it
is the name that documents share. Only windows whose name occurs in two documents or more are
compared, by a hash of the whole window within the shared name. Name and hash are of 64 bits each, under two
independent keys that are drawn for the run, so no texts can be made in advance that collide. A window without
such a symbol (a long run) is its own anchor, so nothing is lost.

Defined results: null and empty texts have no words (n_words 0, nothing removed, the hash of the
empty text). Texts shorter than a window lose nothing. Repeats within one document stay; equal
windows of rows with the same id stay, and each row of an id is cut by its own text. Rows with a null id are kept whole. Texts of any length are
used whole. Extra columns of the input are ignored by removed_words() and kept by drop_repeats().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable, release
from cartoscope.llm.text_hash import Texts, U, chunks, draw_keys, mix, window_hashes

#: Rounds of renaming. Each costs a window at least two words at either end.
ROUNDS = 3
#: A group of consecutive windows is a bit mask, so it has no more windows than this.
WIDEST = 63


def recompress(h: np.ndarray, first: np.ndarray, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each round: starts of the run symbols, starts of the pair symbols, names of the latter.

    h: word names; first: whether a word begins a text (symbols never cross it).
    """
    start, name = np.arange(len(h)), h
    for r in range(rounds):
        head = first[start]
        begins = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | head[1:]])
        length = np.diff(np.r_[begins, len(name)])
        name = np.where(length > 1, mix(name[begins] * U(0x9E3779B97F4A7C15) + length.astype(U)), name[begins])
        start = start[begins]
        runs = start
        head = first[start]
        right = (mix(name + U(0x51ED27 + r)) >> U(63)).astype(bool)
        joined = np.flatnonzero(~right[:-1] & right[1:] & ~head[1:])
        name = name.copy()
        name[joined] = mix(mix(name[joined]) * U(3) + name[joined + 1] + U(r))
        keep = np.ones(len(start), bool)
        keep[joined + 1] = False
        start, name = start[keep], name[keep]
        yield runs, start, name


def anchors(texts: Texts, width: int, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Groups of consecutive windows with one anchor: doc (index), first (word of the first window in the
    document), count, at (of its first window among all windows of the chunk), name; and the hash of every window."""
    h, at = texts.hash, texts.at  # names are made of these, hashes of windows of the second ones
    n = len(h)
    of_word = np.repeat(np.arange(len(at) - 1), np.diff(at))
    p = np.flatnonzero(np.arange(n) + width <= at[of_word + 1]) if n else np.zeros(0, np.int64)
    window = window_hashes(texts.second, width)[p]
    if not len(p):
        empty = np.zeros(0, np.int64)
        return {"doc": empty, "first": empty, "count": empty, "at": empty, "name": empty.astype(U), "hash": window}
    head = np.zeros(n, bool)
    head[at[:-1][at[:-1] < at[1:]]] = True
    low, high = p, p + width
    for runs, start, name in recompress(h, head, rounds):
        for bounds in (runs, start):
            mark = np.zeros(n + 1, np.int32)
            mark[bounds] = 1
            rank = np.cumsum(mark)  # starts at or before each word
            ext = np.r_[bounds, n]
            low = ext[rank[np.minimum(low, n)]]
            high = ext[np.maximum(rank[np.maximum(high, 1) - 1] - 1, 0)]
    i0 = rank[np.minimum(low, n)] - 1
    i1 = rank[np.minimum(high, n)] - 1
    size = np.where(low < high, i1 - i0, 0)
    ok = size > 0
    order = (mix(name ^ U(0xC0FFEE)) >> U(28) << U(28)) | np.arange(len(name), dtype=U)
    chosen = np.full(len(p), -1)
    if ok.any():
        table = [order]
        while 2 << (len(table) - 1) <= size.max():
            step = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        j = np.zeros(len(p), np.int64)
        j[ok] = np.floor(np.log2(size[ok])).astype(np.int64)
        for k, best in enumerate(table):
            these = np.flatnonzero(ok & (j == k))
            a, b = i0[these], i1[these] - (1 << k)
            chosen[these] = (np.minimum(best[a], best[b]) & U((1 << 28) - 1)).astype(np.int64)
    doc = of_word[p]
    new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (doc[1:] != doc[:-1])])
    pick = chosen[new]
    end = np.r_[start, n]
    context = 2 * rounds
    named = mix(window_hashes(h, width)[p[new]] ^ U(7)) if (pick < 0).any() else np.zeros(len(new), U)
    by = np.flatnonzero(pick >= 0)
    if len(by):
        around = window_hashes(h, context)
        named[by] = mix(mix(around[start[pick[by]] - context] + U(1)) + mix(around[end[pick[by] + 1]] + U(2)) * U(3) + name[pick[by]])
    return {"doc": doc[new], "first": p[new] - at[doc[new]], "count": np.diff(np.r_[new, len(p)]), "at": new, "name": named, "hash": window}


def _named(width: int, keys: tuple[int, int]):
    """Rows (name, doc, first, known): the groups of windows of each chunk.

    A name that two documents of the chunk have is shared already: its groups are known and go under names of their own,
    and only the smallest and the largest document stand for the chunk under the name itself (first -1). So a name that
    every document has brings two rows a chunk to its task, not all of its groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _, _ in chunks(batch, lower=False, keys=keys):
                x = anchors(texts, width)
                name, doc, first = x["name"], texts.ids[x["doc"]].astype(np.int64), x["first"].astype(np.int32)
                order = np.lexsort((doc, name))
                name, doc, first = name[order], doc[order], first[order]
                head = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else np.zeros(0, np.int64)
                tail = np.r_[head[1:], len(name)][: len(head)] - 1
                both = doc[head] < doc[tail]
                shared = np.repeat(both, tail - head + 1)
                own = mix(mix(doc[shared].astype(U)) + first[shared].astype(U))
                marks = (doc[head[both]], doc[tail[both]])
                names = np.concatenate([name[~shared], own, name[head[both]], name[head[both]]])
                docs = np.concatenate([doc[~shared], doc[shared], *marks])
                firsts = np.concatenate([first[~shared], first[shared], np.full(2 * int(both.sum()), -1, np.int32)])
                known = np.zeros(len(names), bool)
                known[int((~shared).sum()) : int((~shared).sum()) + int(shared.sum())] = True
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(docs), pa.array(firsts), pa.array(known)], ["name", "doc", "first", "known"])

    return run


def _windowed(width: int, keys: tuple[int, int]):
    """Groups of windows under wanted anchors, with every window's hash. Windows that an earlier document of
    the same chunk also has are settled here: their bits are in mask, and a group settled as a whole carries no hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            for texts, i, j in chunks(batch, lower=False, keys=keys):
                x = anchors(texts, width)
                part = wanted.slice(i, j - i)
                want = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(j - i), np.diff(np.asarray(part.offsets)))
                use = np.isin(x["doc"] << 36 | x["first"], row << 36 | want)
                doc, first, count, at, name = (x[k][use] for k in ("doc", "first", "count", "at", "name"))
                if not len(doc):
                    continue
                group = np.repeat(np.arange(len(doc)), count)
                offs = np.r_[0, np.cumsum(count)]
                step = np.arange(len(group)) - offs[:-1][group]
                hashes = x["hash"][at[group] + step]
                whole = hashes ^ mix(name)[group]
                ids = texts.ids[doc].astype(np.int64)
                order = np.lexsort((ids[group], whole))
                new = np.r_[True, whole[order][1:] != whole[order][:-1]]
                least = ids[group][order][new][np.cumsum(new) - 1]
                later = np.zeros(len(group), bool)
                later[order] = ids[group][order] > least
                mask = np.zeros(len(doc), np.int64)
                np.bitwise_or.at(mask, group, later.astype(np.int64) << step)
                settled = np.add.reduceat(later, offs[:-1], dtype=np.int64) == count
                keep = ~settled[group]
                offs = np.r_[0, np.cumsum(np.where(settled, 0, count))].astype(np.int32)
                name = np.where(settled, mix(ids.astype(U) * U(31) + first.astype(U)), name)
                content = batch.column(3).take(pa.array(doc + i))
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(ids), content, pa.array(first.astype(np.int32)), pa.array(mask), pa.ListArray.from_arrays(pa.array(offs), pa.array(hashes[keep].view(np.int64)))], ["name", "doc", "content", "first", "mask", "hashes"])

    return run


def covered(n_words: int, width: int, firsts: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which words the windows cover: window k of a group stands at first + k if bit k of its mask is set."""
    change = np.zeros(n_words + 1, np.int64)
    bits = (masks[:, None] >> np.arange(width)) & 1
    at = (firsts[:, None] + np.arange(width))[bits.astype(bool)]
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return np.cumsum(change[:-1]) > 0


def _kept(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(2)
            for texts, i, j in chunks(batch, lower=False):
                out = []
                for k in range(j - i):
                    a, b = texts.at[k], texts.at[k + 1]
                    data = texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes()
                    words, removed, cut = data.split(), 0, groups[i + k]
                    if cut.is_valid and len(cut):
                        gone = covered(b - a, width, cut.values.field(0).to_numpy().astype(np.int64), cut.values.field(1).to_numpy())
                        removed = int(gone.sum())
                        words = [w for w, g in zip(words, gone, strict=True) if not g] if removed < len(gone) else []
                    kept = b" ".join(words)
                    out.append((int(b - a), removed, (kept.decode() if removed else None) if with_text else hashlib.sha256(kept).hexdigest()))
                n, removed, last = (list(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(last, pa.string())], ["id", "n_words", "n_removed", "kept"])

    return run


def _repeats(docs: DataFrame, width: int) -> DataFrame:
    """A durable table (id, content, groups): the windows to remove from the text of that id and hash, as groups (first, mask)."""
    if not 1 <= width <= WIDEST:
        raise ValueError(f"width must be from 1 to {WIDEST}: a window group is a mask of so many bits")
    ids, keys = docs.where("id is not null"), draw_keys()
    up = W.partitionBy("name").orderBy("doc").rowsBetween(W.unboundedPreceding, W.currentRow)
    down = W.partitionBy("name").orderBy(F.desc("doc")).rowsBetween(W.unboundedPreceding, W.currentRow)
    named = ids.mapInArrow(_named(width, keys), "name long, doc long, first int, known boolean")
    shared = named.withColumn("lo", F.min("doc").over(up)).withColumn("hi", F.max("doc").over(down)).where("(known or lo < hi) and first >= 0")
    wanted = durable(shared.groupBy(F.col("doc").alias("id")).agg(F.collect_list("first").alias("wanted")), "anchors")
    windows = ids.join(wanted, "id").select("id", "text", "wanted", F.xxhash64("text")).mapInArrow(_windowed(width, keys), "name long, doc long, content long, first int, mask long, hashes array<long>")
    windows = windows.repartition("name")
    each = windows.select("name", "doc", "content", "first", "mask", F.posexplode_outer("hashes").alias("step", "hash"))
    same = W.partitionBy("name", "hash").orderBy("doc").rowsBetween(W.unboundedPreceding, W.currentRow)
    each = each.withColumn("lo", F.min("doc").over(same))
    bit = F.when(F.col("hash").isNotNull() & (F.col("lo") < F.col("doc")), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("step"))).otherwise(F.lit(0).cast("long"))
    masks = each.groupBy("name", "doc", "content", "first").agg(F.bit_or(bit).bitwiseOR(F.max("mask")).alias("mask")).where("mask <> 0")
    out = durable(masks.groupBy(F.col("doc").alias("id"), "content").agg(F.collect_list(F.struct("first", "mask")).alias("groups")), "repeats")
    release(wanted)
    return out


def removed_words(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50) -> DataFrame:
    """Rows (id_col, n_words, n_removed, kept_sha256): each text without the words of windows of width words
    that also start in a document with a smaller id; judged on the input."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = _repeats(docs, width)
    out = docs.withColumn("content", F.xxhash64("text")).join(cut, ["id", "content"], "left").select("id", "text", "groups").mapInArrow(_kept(width, False), "id long, n_words long, n_removed long, kept string")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def _cut(width: int, text_col: str, chars_col: str | None):
    """Rows with their passages cut: (text, groups, row) to the fields of row. Rows of which nothing is left go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _kept(width, True)
        for batch in batches:
            row = batch.column(3)
            fields = {f.name: row.field(k) for k, f in enumerate(row.type)}
            cut = pa.Table.from_batches(kept(iter([batch.select([0, 1, 2])])))["kept"].combine_chunks() if len(batch) else pa.array([], pa.string())
            fields[text_col] = pc.coalesce(cut, fields[text_col])
            if chars_col:
                fields[chars_col] = pc.coalesce(pc.utf8_length(cut).cast(fields[chars_col].type), fields[chars_col])
            stay = pc.not_equal(pc.fill_null(pc.utf8_length(cut), -1), 0)
            yield pa.RecordBatch.from_arrays(list(fields.values()), list(fields)).filter(stay)

    return run


def drop_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50, chars_col: str | None = None) -> DataFrame:
    """The input with repeated passages cut from text_col: a changed text is its kept words joined by one
    space, others stay as they are. Documents of which nothing is left go. chars_col: a length to keep in step.

    Cuts are joined by id and content, so rows that share an id keep their own words."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    cut = _repeats(docs.select("id", "text"), width)
    return docs.withColumn("content", F.xxhash64("text")).join(cut, ["id", "content"], "left").select("id", "text", "groups", "row").mapInArrow(_cut(width, text_col, chars_col), documents.schema)
