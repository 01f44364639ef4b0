"""Ranked search against a loop over documents and items."""

import math
import re

import numpy as np
import pytest

from cartoscope.llm import queries, term_scan
from tests import oracle

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def expected(docs, items, k):
    read = [(i, words(t)) for i, t in docs if words(t)]
    n_docs, n_words = len(read), sum(len(w) for _, w in read)
    df = {}
    for _, w in read:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    out = []
    for item, some in terms.items():
        scored = []
        for doc, w in read:
            m = 100 - 90 + (90 * len(w) * n_docs) // n_words
            score = 0
            for t in some:
                if tf := w.count(t):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return out


def run(spark, docs, items, k=10, kind="long"):
    d = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in docs], "doc_id long, text string, n long, item long, term string").repartition(3)
    b = spark.createDataFrame([(i, t, 5) for i, t in items], f"item_id {kind}, text string, rank int")
    return [tuple(r) for r in term_scan.search(d, b, k=k).collect()]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(150)] + ["Ñandú", "ñandú", "ÜBER", "e", "E", "a", "aa", "aaa", "日本"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    docs = [(i, ("-" if i % 2 else " \n").join(text(int(n)).split())) for i, n in enumerate(rng.integers(1, 200, 120))]
    docs += [(None, docs[3][1]), (None, None), (200, ""), (201, "\x00 ..,"), (202, docs[3][1]), (3, docs[3][1]), (203, text(20000)), (204, "w1"), (205, "aaa aa a aaaa"), (206, "E" * 5000)]
    items = [(i, text(int(n))) for i, n in enumerate(rng.integers(1, 40, 25))]
    items += [(30, ""), (31, None), (None, "w3 w4"), (32, "unseen"), (33, "aa"), (34, "W1, w1. w1"), (2, text(5)), (4, items[4][1]), (35, "é"), (36, "日本 ñandú")]
    return docs, items


@pytest.mark.parametrize("k", [1, 10, 500])
def test_ranks(spark, corpus, k):
    docs, items = corpus
    assert sorted(run(spark, docs, items, k), key=key) == sorted(expected(docs, items, k), key=key)


def test_many_blocks_and_small_steps(spark, corpus, monkeypatch):
    """What is held at a time changes no result."""
    docs, items = corpus
    monkeypatch.setattr(term_scan, "BLOCK_CHARS", 700)
    monkeypatch.setattr(term_scan, "ENTRIES", 40)
    assert sorted(run(spark, docs, items), key=key) == sorted(expected(docs, items, 10), key=key)


def test_sums_beyond_a_double():
    value = np.array([(1 << 44) + 1] * 3000 + [7], np.int64)
    assert term_scan._summed(np.zeros(len(value), np.int64), value, 2).tolist() == [3000 * ((1 << 44) + 1) + 7, 0]


@pytest.mark.parametrize(("docs", "items"), [([], []), ([(1, "a b")], []), ([], [(1, "a b")]), ([(1, None)], [(None, None)]), ([(1, "a a"), (2, "b"), (3, "b c")], [(1, "A"), (2, ".")])])
def test_empty_tables(spark, docs, items):
    assert sorted(run(spark, docs, items)) == sorted(expected(docs, items, 10))


def test_items_named_by_strings(spark):
    docs = [(1, "a b"), (2, "b"), (3, "c")]
    assert [(r[0], r[2]) for r in sorted(run(spark, docs, [("x", "a"), ("y", "c")], kind="string"))] == [("x", 1), ("y", 3)]


def test_query_equals_its_sql(spark):
    columns, rows = oracle.rows_of(queries.op11_lexical_search(spark, oracle.SF))
    expected_columns, wanted = oracle.sql_rows(oracle.connection(), queries.OP11_SQL)
    assert columns == expected_columns and len(rows) > 100 and oracle.same(rows, wanted)
