"""Alignment against whole-text encoding, and offsets and links one by one."""

import collections
import hashlib

import numpy as np
import pytest

from cartoscope.llm import alignment, queries

A_FILE, B_FILE = queries.byte_model_file(), queries.model_file()


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def aligned(text, libraries):
    """Groups [(a ids, b ids)] of one text; None without tokens."""
    a, b = libraries
    if not text:
        return None
    letters = alignment.byte_letters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    ends = [np.cumsum([len(x) for x in some]).tolist() for some in (bytes_a, bytes_b)]
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        out.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return out


def expected(docs, libraries):
    found = [(i, aligned(t, libraries)) for i, t in docs]
    links = [[(x, y) for a, b in groups or () for x in a for y in b] for _, groups in found]
    counts = collections.Counter(p for some in links for p in set(some))
    most = collections.defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (i, groups), some in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or ())
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = [sum(len(g[k]) for g in groups or ()) for k in (0, 1)]
        out.append((i, *sizes, len(groups or ()), len(some), sum(counts[p] == most[p[0]] for p in some), sum(counts[p] for p in some), digest))
    return out


TEXTS = [
    "Hello world, it's a test of   spaces\n\nand lines.", "  two before", "behind  ", " ", "\n", "\t tab", "a", None, "", "naïve café 東京 🙂 👩‍👩‍👧 x", "mark ▁ inside", "▁", "<s> </s> <unk> <|endoftext|> <0x41>",
    "don't 'll we've I'D 's", "nul \x00 and \x1c \x1f odd \x85 white\xa0space   wide ᠎ old ​ zero", "x" * 700, "é" * 300, "1234567 89.00 -- ... !!", "á combining é", "Hello world, it's a test of   spaces\n\nand lines.", "﻿bom here", "ab ​cd ef", "tail\n", "aa " * 400,
]


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(13)
    words = "the of and ing tion Über straße niño 12 a-b c's (x) ¿qué? 東京 ok. \n end".split(" ")
    texts = [*TEXTS, *[" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 150, 40)], " ".join(rng.choice(words, 9000))]
    odd = [chr(c) for c in (*range(0, 0x180), 0x2000, 0x2028, 0x3000, 0xFFFD, 0x1F600, 0x180E, 0x200B, 0x200D, 0xFEFF, 0x2581)]
    texts += ["".join(rng.choice([*odd, " ", " ", "a", "b"], int(n))) for n in rng.integers(1, 60, 200)]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[0])]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, chunk long, sha string, n_a int").repartition(3)


def key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("small", [False, True])
def test_counts_and_digests(spark, corpus, libraries, monkeypatch, small):
    if small:  # many chunks, steps, tables and rows of the state vector
        monkeypatch.setattr(alignment, "CHUNK_BYTES", 3000)
        monkeypatch.setattr(alignment, "STEP_BYTES", 700)
        monkeypatch.setattr(alignment, "TABLE_CHARS", 2000)
        monkeypatch.setattr(alignment, "ROW_TOKENS", 3)
    got = [tuple(r) for r in alignment.align(frame(spark, corpus), A_FILE, B_FILE).collect()]
    assert sorted(got, key=key) == sorted(expected(corpus, libraries), key=key)


def test_groups(spark, corpus, libraries):
    docs = [(i, t) for i, (_, t) in enumerate(corpus)]
    got = {r.doc_id: r for r in alignment.groups(frame(spark, docs), A_FILE, B_FILE).collect()}
    for i, t in docs:
        r, wanted = got[i], aligned(t, libraries) or []
        bounds = list(zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends))
        assert [(r.a[a:b], r.b[c:d]) for a, b, c, d in bounds] == wanted, t


def test_empty_tables(spark):
    assert alignment.align(frame(spark, [(1, None)]).limit(0), A_FILE, B_FILE).collect() == []
    assert [tuple(r) for r in alignment.align(frame(spark, [(1, None), (None, "")]), A_FILE, B_FILE).orderBy("doc_id").collect()] == [(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_numbers_survive_packing():
    values = np.array([0, 1, 255, 256, 70_000, 1 << 31], np.int64)
    assert alignment.unpacked(alignment.packed(values)).tolist() == values.tolist()


def test_query_on_the_given_table(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op13_alignment(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=key) == sorted(expected(docs, libraries), key=key)
