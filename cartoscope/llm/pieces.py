"""SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the vocabulary has a whitespace marker after another character, so merges never cross
the place where a marker follows a word. A text is therefore cut into marked words (a run of markers and
the word behind it), each distinct marked word of a batch is segmented and decoded once by the
library, and the ids are joined back by position. The table is kept for the following batches of
the task, up to a bound; a new one is begun beyond it. The cut is checked against the vocabulary,
and a vocabulary that has a crossing piece is encoded text by text.

Defined results: a null text counts as empty, and an empty text has the end id alone (if asked for)
and decodes to the empty text. Texts of any length are encoded whole. Rows keep their ids, null or
repeated; extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Characters of marked words that a task's table holds before a new one is begun.
TABLE_CHARS = 4_000_000
#: Bytes of text that are cut at a time.
PART_BYTES = 1 << 20


class ChunkTable:
    """Distinct marked words with what the library makes of them."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.crosses = any(MARK in p.lstrip(MARK) for p in pieces)
        # a text gets a marker in front, unless the model adds none
        self.prefix = self.model.id_to_piece(self.model.encode("a")[0]).startswith(MARK)
        self.known: dict[str, tuple[int, str, str]] = {}
        self.held = 0

    def chunks(self, text: str) -> list[str]:
        """Marked words of a text, as the library's normalizer marks it."""
        text = text.replace(" ", MARK)
        return CHUNK.findall(MARK + text if self.prefix and text else text)

    def learn(self, words: set[str]) -> None:
        """Segment the words that the table lacks, each once, and decode them."""
        new = [w for w in words if w not in self.known]
        if self.held > TABLE_CHARS:
            self.known, self.held, new = {}, 0, list(words)
        # the first marker of a marked word is the one that the library puts in front of every text
        ids = self.model.encode([w[1:] if self.prefix and w[0] == MARK and len(w) > 1 else w for w in new], num_threads=1)
        texts = self.model.decode(ids, num_threads=1) if new else []
        for w, i, t in zip(new, ids, texts, strict=True):
            if self.prefix and (w[0] != MARK or len(w) == 1):  # cannot be made by a prefixed text: pieces one by one
                i = self._bare(w)
                t = self.model.decode([*self.model.encode("a"), *i])[1:] if i else ""
            elif self.prefix:
                t = " " + t
            self.known[w] = (len(i), " ".join(map(str, i)), t)
            self.held += len(w) + 100

    def _bare(self, word: str) -> list[int]:
        """Ids of a word as it stands in a text's inside or, for a lone marker, at its end."""
        if word == MARK:
            return [self.model.piece_to_id(MARK)]
        # a word without a marker stands only behind nothing; the library never makes one with a prefix
        raise ValueError(f"no marker in {word[:20]!r}")

    def encode(self, texts: list[str], end: bool) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, decimal ids joined by one space, decoded text."""
        tail = self.model.eos_id()
        if self.crosses:
            for text in texts:
                ids = self.model.encode(text, add_eos=end)
                yield len(ids), " ".join(map(str, ids)), self.model.decode(ids)
            return
        cut = [self.chunks(t) for t in texts]
        self.learn(set().union(*cut))
        known = self.known
        for words in cut:
            found = [known[w] for w in words]
            ids = [f[1] for f in found] + [str(tail)] * end
            text = "".join([f[2] for f in found])
            yield sum([f[0] for f in found]) + end, " ".join(ids), text[1:] if self.prefix and text else text


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of a column of about PART_BYTES of text, so that only these are Python strings at a time."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PART_BYTES, "right")))
        yield column.slice(i, j - i)
        i = j


def _encoded(model_file: str, end: bool, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_file)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            at = 0
            for part in _parts(batch.column(1)):
                part = [t or "" for t in part.to_pylist()]
                n, ids, text = (list(x) for x in zip(*table.encode(part, end), strict=True))
                if digests:
                    last = [pa.array(map(sha, ids)), pa.array(map(sha, text))]
                else:
                    last = [pa.array([[int(i) for i in x.split()] for x in ids], pa.list_(pa.int32())), pa.array(text)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(n, pa.int64()), *last], ["id", "n", "ids", "decoded"])
                at += len(part)

    return run


def encode_decode(documents: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text", end: bool = True, digests: bool = False) -> DataFrame:
    """Rows (id_col, n_tokens, ids, decoded) of every text; with digests ids_sha256 and decoded_sha256 in their place.

    model_file: a SentencePiece model that every executor has at the same path.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    lists = "string" if digests else "array<int>"
    out = docs.mapInArrow(_encoded(model_file, end, digests), f"id {kind}, n long, ids {lists}, decoded string")
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), F.col("ids").alias(names[0]), F.col("decoded").alias(names[1]))
