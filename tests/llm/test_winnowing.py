"""Winnowing against a brute-force search of all windows."""

import hashlib
import re

import numpy as np
import pytest

from cartoscope.llm import queries, winnowing
from tests import oracle

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string, item string, words string, hits string, row long, size int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, width):
    """Per document, by trying every window of every item at every place."""
    listed = [(i, words(t)) for i, t in items]
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = np.zeros(len(w), bool), set()
        for item, v in listed:
            m = min(width, len(v))
            wins = {tuple(v[p : p + m]) for p in range(len(v) - m + 1)} if m else set()
            for p in range(len(w) - m + 1 if m else 0):
                if tuple(w[p : p + m]) in wins:
                    hit[p : p + m] = True
                    found |= set() if item is None else {str(item)}  # an item without an id is not listed
        out.append((doc_id, len(w), int(hit.sum()), sorted(found), bool(hit.any())))
    return out


def run(spark, docs, items, width=10):
    d = spark.createDataFrame([(i, t, "x", "y", "z", 7, 3) for i, t in docs], DOC)
    b = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, fp long")
    return winnowing.decontaminate(d, b, width=width)


def key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ñandú", "ÜBER", "x1", "e", "E"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(int(n))) for i, n in enumerate(rng.integers(10, 40, 12))]
    # short items, one word, none, null, a null id, copies, repeated ids, a run of one word
    items += [(20, "w1 w2 w3"), (21, "w59"), (22, ""), (23, None), (None, text(15)), (24, items[0][1]), (0, items[1][1]), (25, "w7 " * 30), (26, "w1 w2 w3"), (27, " ".join(["a b c d e f g h i j"] * 4))]
    docs = []
    for k in range(40):
        w = text(int(rng.integers(1, 120))).split()
        for _, t in [items[int(rng.integers(0, 12))] for _ in range(k % 3)]:
            v = t.split()
            a = int(rng.integers(0, max(1, len(v) - 9)))
            b = a + int(rng.integers(8, 14))  # some too short, some just long enough
            at = int(rng.integers(0, len(w)))
            w[at:at] = [x.upper() if k % 2 and x.isascii() else x for x in v[a:b]]
        docs.append((k, (", " if k % 5 else "\n\t-- ").join(w)))
    docs += [(None, items[2][1]), (None, None), (50, ""), (51, " .. \x7f"), (3, docs[3][1]), (3, items[4][1]), (52, "w7 " * 200), (53, "w7 " * 9), (54, "a b c d e f g h i j " * 6), (55, text(6000) + " " + items[5][1])]
    return docs, items


@pytest.mark.parametrize("width", [10, 5, 1])
def test_windows(spark, corpus, width):
    docs, items = corpus
    got = [tuple(r) for r in run(spark, docs, items, width).collect()]
    assert sorted(got, key=key) == sorted(expected(docs, items, width), key=key)


def test_shuffled_windows_and_a_full_bit_table(spark, corpus, monkeypatch):
    """Nothing depends on what may be broadcast or on the size of the bit table."""
    docs, items = corpus
    monkeypatch.setattr(winnowing, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(winnowing, "MOST_BITS", 64)
    got = [tuple(r) for r in run(spark, docs, items).collect()]
    assert sorted(got, key=key) == sorted(expected(docs, items, 10), key=key)


@pytest.mark.parametrize(("docs", "items"), [([], []), ([(1, "a b")], []), ([], [(1, "a b")]), ([(1, None)], [(None, None)]), ([(1, "a b c"), (2, "b")], [(1, "B")])])
def test_empty_tables(spark, docs, items):
    assert [tuple(r) for r in run(spark, docs, items).orderBy("doc_id").collect()] == expected(docs, items, 10)


def test_query_equals_its_sql(spark):
    con = oracle.connection()
    columns, rows = oracle.rows_of(queries.op12_decontamination(spark, oracle.SF))
    expected_columns, wanted = oracle.sql_rows(con, queries.OP12_SQL)
    assert columns == expected_columns and oracle.same(rows, wanted)
    assert any(r[columns.index("contaminated")] for r in rows)


def test_digest_of_no_items(spark):
    r = winnowing.digests(run(spark, [(1, "a")], [])).first()
    assert (r.n_items, r.items_sha256, r.contaminated) == (0, hashlib.sha256(b"").hexdigest(), False)
