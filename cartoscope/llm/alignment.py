"""Cross-tokenizer alignment by lockstep merging.

A byte-level BPE (A) and a SentencePiece BPE (B) encode the same text. The byte offsets at which a token of both ends
cut the two sequences into groups, and all tokens of a group are linked with each other. The offsets of a batch of
documents are merged in lockstep: one state vector holds a pointer into A and one into B for every document, each
step moves the pointer of the smaller offset (both where they are equal, which is a cut), and finished documents
leave the vector. A long document enters as several rows of the vector, parted at word starts where both
tokenizers cut in any case, so the number of steps does not follow the longest text. Links are the pairs between two cuts.

Neither tokenizer merges over a single space between two visible characters, so texts are parted there and each
distinct part of a task is encoded once by the libraries (a bounded table, as for decoding; a SentencePiece model
with a piece that crosses spaces encodes whole texts).

How many documents of the corpus hold a pair of ids is counted in two steps: a task counts the pairs of a chunk of
documents (a few megabytes of text), and the chunks' counts are added up by pair. What a document needs of the counts
comes back by chunk: a chunk has each of its pairs once, and its documents refer to them by place. So neither
texts nor links are shuffled, and a pair that all documents have is one row a chunk.

Defined results: null and empty texts, and texts that the joined bytes of one tokenizer's tokens do not give back, have no tokens:
all numbers 0 and no groups. Each row is a document of its own: repeated rows count twice, rows with a null id too. Texts of
any length are encoded whole; extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable

#: Bytes of text in a chunk of documents (one document at least).
CHUNK_BYTES = 4 << 20
#: Bytes of text that are encoded at a time.
STEP_BYTES = 1 << 20
#: Characters of distinct parts that a task's table holds before a new one is begun.
TABLE_CHARS = 30_000_000
#: Parts that are encoded as one text, with the spaces at which they were parted.
TOGETHER = 500
#: Tokens of A in one row of the state vector, beyond which a document goes on in another row.
ROW_TOKENS = 96
#: A space between characters that are white space for no tokenizer.
SEEN = "[^\\s\\u180e\\u200b-\\u200d\\ufeff]"
PARTING = re.compile(f"(?<={SEEN}) (?={SEEN})")
#: A part that may stand between two such spaces, and that both tokenizers give back as it is.
PLAIN = re.compile(f"(?!.*\u2581){SEEN}(.*{SEEN})?", re.DOTALL)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """The two tokenizers, the bytes of their tokens, and a table of the parts that were encoded."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to the tasks
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.crosses = any("▁" in p.lstrip("▁") for p in pieces)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held, self.good = 0, np.zeros(0, bool)
        self.pools = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # ids of part i: pool[ends[i]:ends[i + 1]]

    def parts(self, text: str) -> list[str]:
        """A text without the spaces at which it is parted; one of them stands before the first part too."""
        return [text] if self.crosses else PARTING.split(text)

    def learn(self, cut: list[list[str]]) -> None:
        """Encode the parts that the table lacks, each once."""
        if self.held > TABLE_CHARS:
            self._clear()
        new = list(dict.fromkeys(p for p in chain.from_iterable(cut) if p not in self.known))
        if not new:
            return
        odd = [p for p in new if not PLAIN.fullmatch(p)]
        if odd and not self.crosses:
            new = [*(p for p in new if PLAIN.fullmatch(p)), *odd]
        plain = new[: len(new) - len(odd)] if not self.crosses else []
        self.known |= dict(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.held += sum(map(len, new)) + 100 * len(new)
        if plain and not self._learn_together(plain):
            plain = []
        self._learn_each(new[len(plain) :])

    def _learn_together(self, parts: list[str]) -> bool:
        """Encode parts as a few texts, and cut the ids at the parts' ends; False if one tokenizer does not end a token there."""
        texts = [" ".join(parts[i : i + TOGETHER]) for i in range(0, len(parts), TOGETHER)]
        whole = "".join([" " + t for t in texts]).encode()
        ids = ([x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1))
        bounds = np.cumsum([1 + len(p.encode()) for p in parts])
        found = []
        for x, names, sizes in zip(ids, (self.a_bytes, self.b_bytes), (self.a_size, self.b_size), strict=True):
            flat = np.concatenate([np.array(i, np.int32) for i in x])
            ends = np.cumsum(sizes[flat])
            at = np.searchsorted(ends, bounds)
            if b"".join(map(names.__getitem__, chain.from_iterable(x))) != whole or not np.array_equal(ends[at], bounds):
                return False
            found.append((flat, at + 1))
        self.good = np.concatenate([self.good, np.ones(len(parts), bool)])
        for k, (flat, ends) in enumerate(found):
            self._append(k, flat, ends)
        return True

    def _append(self, k: int, flat: np.ndarray, ends: np.ndarray) -> None:
        self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + ends])
        self.pools[k] = np.concatenate([self.pools[k], flat])

    def _learn_each(self, parts: list[str]) -> None:
        if not parts:
            return
        a = [x.ids for x in self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)]
        b = self.b.encode(parts, num_threads=1)
        good = [self._joined(x, y) == (" " + p).encode() for p, x, y in zip(parts, a, b, strict=True)]
        self.good = np.concatenate([self.good, good])
        for k, ids in enumerate((a, b)):
            self._append(k, np.fromiter(chain.from_iterable(ids), np.int32), np.cumsum(list(map(len, ids))))

    def _joined(self, a: list[int], b: list[int]) -> bytes | None:
        """The bytes of both sequences; None if they differ."""
        one, two = b"".join([self.a_bytes[i] for i in a]), b"".join([self.b_bytes[i] for i in b])
        return one if one == two else None

    def tokens(self, k: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one behind the other by tokenizer k (0: A), and how many each part has."""
        ends = self.ends[k]
        n = ends[codes + 1] - ends[codes]
        return self.pools[k][np.arange(n.sum()) + np.repeat(ends[codes] - (np.cumsum(n) - n), n)], n


def lockstep(end_a: np.ndarray, end_b: np.ndarray, row_a: np.ndarray, row_b: np.ndarray, stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A and of B end at a cut.

    end_a, end_b: end offsets of all tokens. Row i of the state vector begins at the tokens row_a[i] and row_b[i]; its last
    token of A is stop_a[i] - 1, which ends where one of B does.
    """
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    live = row_a < stop_a
    a, b, stop = row_a[live], row_b[live], stop_a[live]
    while len(a):
        x, y = end_a[a], end_b[b]
        equal = x == y
        cut_a[a[equal]] = True
        cut_b[b[equal]] = True
        b = b + (y <= x)
        a = a + (x <= y)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return cut_a, cut_b


class Aligned:
    """Tokens, cuts and links of a list of texts."""

    def __init__(self, pair: Pair, texts: list[str]):
        cut = [pair.parts(t) if t else [] for t in texts]
        pair.learn(cut)
        codes = [np.fromiter(map(pair.known.__getitem__, c), np.int64, len(c)) for c in cut]
        self.good = [bool(len(c)) and bool(pair.good[c].all()) for c in codes]
        codes = [c if g else c[:0] for c, g in zip(codes, self.good, strict=True)]
        parts = np.array(list(map(len, codes)), np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *codes])
        self.a, n_a = pair.tokens(0, flat)
        self.b, n_b = pair.tokens(1, flat)
        first = np.r_[0, np.cumsum(parts)]  # part of each text
        start_a, start_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
        self.at_a, self.at_b = start_a[first], start_b[first]  # of text i: tokens at_a[i]:at_a[i + 1]
        # a row of the state vector begins with each text, and again after every ROW_TOKENS or more of its tokens
        text = np.repeat(np.arange(len(texts)), parts)
        turn = (start_a[:-1] - self.at_a[text]) // ROW_TOKENS
        heads = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (turn[1:] != turn[:-1])]) if len(flat) else np.zeros(0, np.int64)
        row_a = start_a[heads]
        self.cut_a, self.cut_b = lockstep(np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b]), row_a, start_b[heads], np.r_[row_a[1:], len(self.a)][: len(heads)])
        # group g: tokens end_a[g - 1] + 1 to end_a[g], and the same of B
        self.end_a, self.end_b = np.flatnonzero(self.cut_a), np.flatnonzero(self.cut_b)
        self.in_a, self.in_b = np.diff(np.r_[-1, self.end_a]), np.diff(np.r_[-1, self.end_b])
        self.at_group = np.searchsorted(self.end_a, self.at_a)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and pair of ids (A id * number of B ids, and B id) of every link."""
        group = np.cumsum(self.cut_a) - self.cut_a  # of each token of A
        fan = self.in_b[group]
        first_b = np.cumsum(self.in_b) - self.in_b
        other = np.arange(fan.sum()) + np.repeat(first_b[group] - (np.cumsum(fan) - fan), fan)
        text = np.searchsorted(self.at_a, np.arange(len(self.a)), "right") - 1
        return np.repeat(text, fan), np.repeat(self.a.astype(np.int64), fan) << 32 | self.b[other]

    def written(self) -> list[bytes]:
        """Groups of each text as `a1,a2|b1;a3|b2,b3`."""
        n_a, n_b = len(self.a), len(self.b)
        # tokens in writing order: those of a group's A before those of its B
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        place_a = np.arange(n_a) + np.r_[0, np.cumsum(self.in_b)][group_a]
        place_b = np.arange(n_b) + np.r_[0, np.cumsum(self.in_a)][group_b + 1]
        ids, mark = np.zeros(n_a + n_b, np.int32), np.zeros(n_a + n_b, np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(self.cut_a, ord("|"), ord(","))
        mark[place_b] = np.where(self.cut_b, ord(";"), ord(","))
        digits = np.empty((len(ids), 11), np.uint8)
        shown = np.ones((len(ids), 11), bool)
        digits[:, 10] = mark
        rest = ids
        for k in range(9, -1, -1):
            rest, digit = np.divmod(rest, 10)
            digits[:, k] = digit + 48
            shown[:, k] = (digit > 0) | (rest > 0) | (k == 9)
            if not rest.any():
                shown[:, :k] = False
                break
        out = digits[shown]
        size = np.r_[0, np.cumsum(shown.sum(1))]
        bounds = size[self.at_a + self.at_b]
        return [out[i : max(i, j - 1)].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def _steps(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes of text, one row at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, "right")))
        yield i, j
        i = j


def _groups(a_file: str, b_file: str):
    """Rows (id, text) to (id, a, b, a_ends, b_ends)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(a_file, b_file)
        for batch in batches:
            for i, j in _steps(batch.column(1), STEP_BYTES):
                x = Aligned(pair, batch.column(1).slice(i, j - i).to_pylist())
                ends = [end + 1 - np.repeat(at[:-1], np.diff(x.at_group)) for end, at in ((x.end_a, x.at_a), (x.end_b, x.at_b))]
                lists = [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v.astype(np.int32))) for o, v in ((x.at_a, x.a), (x.at_b, x.b), (x.at_group, ends[0]), (x.at_group, ends[1]))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *lists], ["id", "a", "b", "a_ends", "b_ends"])

    return run


def groups(documents: DataFrame, a_file: str, b_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, a, b, a_ends, b_ends): ids of both tokenizers, and how many of them stand before the end of each group.

    a_file: a byte-level BPE of the tokenizers library, b_file: a SentencePiece model; every executor has them at the same paths.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_groups(a_file, b_file), f"id {kind}, a array<int>, b array<int>, a_ends array<int>, b_ends array<int>")
    return out.withColumnRenamed("id", id_col)


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers, all lowest bytes first, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Chunk:
    """The links of a chunk of documents: its distinct pairs, how many documents have each, and each document's pairs by place."""

    def __init__(self):
        self.rows: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: Aligned, texts: int) -> None:
        text, pair = x.links()
        names, code = np.unique(pair, return_inverse=True) if len(pair) else (pair, pair)
        key, n = np.unique(text << 32 | code, return_counts=True)
        head = np.searchsorted(key, np.arange(texts + 1) << 32)
        pairs = names[key & 0xFFFFFFFF]
        self.rows += [(pairs[i:j], n[i:j]) for i, j in zip(head[:-1], head[1:], strict=True)]

    def finish(self) -> tuple[np.ndarray, np.ndarray, list[bytes | None], list[bytes | None]]:
        """Pairs, documents of each, and for each document its places (as differences) and its links at each."""
        flat = np.concatenate([np.zeros(0, np.int64), *[p for p, _ in self.rows]])
        names, place = np.unique(flat, return_inverse=True) if len(flat) else (flat, flat)
        ends = np.cumsum([len(p) for p, _ in self.rows]).astype(np.int64)
        places = np.split(place, ends[:-1]) if len(ends) else []
        steps = [packed(np.diff(p, prepend=0)) if len(p) else None for p in places]
        return names, np.bincount(place, minlength=len(names)), steps, [packed(n) if len(n) else None for _, n in self.rows]


FIELDS = "chunk long, id long, n_a long, n_b long, n_groups long, n_links long, sha string, places binary, times binary, pairs array<long>, docs array<long>"


def _counted(a_file: str, b_file: str):
    """Rows (id, text) to a row for each document and one for each chunk (with pairs, without an n_a); see FIELDS."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = Pair(a_file, b_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last in _steps(batch.column(1), CHUNK_BYTES):
                ids, column = batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first)
                chunk, numbers, sha = Chunk(), [], []
                for i, j in _steps(column, STEP_BYTES):
                    x = Aligned(pair, column.slice(i, j - i).to_pylist())
                    links = np.r_[0, np.cumsum(x.in_a * x.in_b)][x.at_group]
                    numbers.append(np.stack([np.diff(v) for v in (x.at_a, x.at_b, x.at_group, links)]))
                    sha += [hashlib.sha256(w).hexdigest() if w else "" for w in x.written()]
                    chunk.add(x, j - i)
                pairs, docs, places, times = chunk.finish()
                n = len(ids)
                none = pa.nulls(n, pa.list_(pa.int64()))
                columns = [pa.array(np.full(n, number)), ids, *map(pa.array, np.concatenate(numbers, axis=1)), pa.array(sha), pa.array(places, pa.binary()), pa.array(times, pa.binary()), none, none]
                yield pa.RecordBatch.from_arrays(columns, names)
                if len(pairs):
                    null = [pa.nulls(1, t) for t in (*[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary())]
                    yield pa.RecordBatch.from_arrays([pa.array([number]), *null, pa.array([pairs], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))], names)
                number += 1

    return run


def _weighed(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of a chunk with what the counts of their links come to; pairs: place, count, best."""
    place, count, best = (pairs[c].to_numpy() for c in ("place", "count", "best"))
    size = int(place.max(initial=-1)) + 1
    counts, bests = np.zeros(size, np.int64), np.zeros(size, np.int64)
    counts[place], bests[place] = count, best
    sums = []
    for steps, times in zip(docs["places"].to_pylist(), docs["times"].to_pylist(), strict=True):
        at, n = (np.cumsum(unpacked(steps)), unpacked(times)) if steps else (np.zeros(0, np.int64),) * 2
        sums.append((int(n @ bests[at]), int(n @ counts[at])))
    n_best, count_sum = zip(*sums, strict=True) if sums else ((), ())
    return docs.select(["id", "n_a", "n_b", "n_groups", "n_links", "sha"]).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align(documents: DataFrame, a_file: str, b_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A pair's count is the number of documents of the corpus that hold it linked; n_best are the links whose count is the
    highest of their A id, count_sum is the sum of the counts of all links. groups() gives the groups themselves.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    read = durable(docs.mapInArrow(_counted(a_file, b_file), FIELDS), "aligned")
    each = read.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x"))
    each = each.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = durable(each.groupBy("pair").agg(F.sum("docs").alias("count")), "counts")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))  # no more rows than A has ids
    marked = counts.join(F.broadcast(best), F.shiftright("pair", 32) == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    weights = each.join(marked, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    texts = read.where("n_a is not null").drop("pairs", "docs")
    kinds = "id long, n_a long, n_b long, n_groups long, n_links long, sha string, n_best long, count_sum long"
    out = texts.groupBy("chunk").cogroup(weights.groupBy("of")).applyInArrow(_weighed, kinds)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256"))
