"""The ten operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoscope.llm import bloom_cascade, flat_graph, license_scan, mixing, partenum, pieces, progressive_jpeg, queries, recompression, text_hash, tool_calls, toxicity

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, sig string, name string, key string, level0 string"


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or ""), "x", "y", "z", "w") for k, (i, t) in enumerate(zip(ids, texts))], DOC)


WORDS = [f"w{i}" for i in range(400)]


def random_text(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def mixed():
    """Nulls, empties, copies, near copies, shared passages, runs and a long text."""
    rng = np.random.default_rng(5)
    base = [random_text(rng, int(n)) for n in rng.integers(1, 300, 30)]
    passage = random_text(rng, 70)
    out = [*base, *base[:6], None, "", "   ", "a", "A b", passage, f"x {passage} y", "same " * 130, "same " * 70, f"{base[3]} tail", random_text(rng, 9000)]
    for t in base[:12]:
        w = t.split()
        w[len(w) // 2] = "CHANGED"
        out.append(" ".join(w))
        out.append(" ".join([*w[: len(w) // 2], passage, *w[len(w) // 2 :]]))
    return out


def shingles(text, q):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + q]) for k in range(len(w) - q + 1)) if len(w) >= q else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("q", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(spark, mixed, q, percent):
    sets = [shingles(t, q) for t in mixed]
    root = list(range(len(sets)))
    changed = True
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(root[i], root[j])
            changed |= root[i] != low or root[j] != low
            root[i] = root[j] = low
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_components(docs(spark, mixed), q=q, percent=percent).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_signatures_meet(spark):
    """Any two sets within the threshold share a signature."""
    rng = np.random.default_rng(6)
    for percent in (80, 85):
        low = partenum.bands(percent, 1 << 14)
        for n in (1, 2, 3, 5, 8, 13, 40, 150, 900):
            for _ in range(10):
                a = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
                drop = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                b = np.sort(np.r_[a[drop:], rng.integers(0, 2**62, int(rng.integers(0, 3))).astype(np.uint64)])
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = (partenum.signatures(v, np.array([len(v)]), percent, low)[0] for v in (a, b))
                    assert len(np.intersect1d(x, y)) or np.array_equal(a, b)


def thue_morse(a, b, n):
    out, flip = [a], {a: b, b: a}
    while len(out) < n:
        out += [flip[c] for c in out]
    return "".join(out)


def test_sketches_bound_the_difference(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 3, 200, 256, 300, 2000)]
    sets += [sets[-1][:1700], sets[-2][:250], sets[3][3:], sets[0][:0]]
    bits, longs = partenum.sketches(np.concatenate(sets), np.array([len(x) for x in sets]))
    parts = np.split(bits.view(np.int64), np.cumsum(longs)[:-1])
    assert all(64 * n >= len(x) and n & (n - 1) == 0 for n, x in zip(longs, sets, strict=True))
    rows = [(i, j, parts[i].tolist(), parts[j].tolist()) for i in range(len(sets)) for j in range(len(sets))]
    odd = {(r.i, r.j): r.odd for r in spark.createDataFrame(rows, "i int, j int, x array<long>, y array<long>").selectExpr("i", "j", f"{partenum._odd('x', 'y')} AS odd").collect()}
    for (i, j), n in odd.items():
        differ = len(np.setxor1d(sets[i], sets[j]))
        assert n <= differ and n % 2 == differ % 2
    assert odd[5, 5] == 0 and 180 * odd[4, 3] > 20 * (300 + 256)  # unlike sets are told apart


def test_chance_meetings_move_no_sets(spark, monkeypatch):
    """Of pairs that are compared, those too far apart by their sketches never have their shingles moved."""
    rng = np.random.default_rng(6)
    base = [[f"w{rng.integers(10**9)}" for _ in range(n)] for n in (300, 300, 300, 900)]
    texts = [" ".join(w) for w in base] + [" ".join([*base[0][:298], "x", "y"])]
    kept, likely = [], partenum._likely
    monkeypatch.setattr(partenum, "_likely", lambda *a: kept.append(likely(*a)) or kept[-1])
    table, how = docs(spark, texts).selectExpr("doc_id AS id", "text"), partenum.Shingles(5, partenum.draw_keys())
    sets = table.mapInArrow(partenum._measured(how), "doc_id long, n_shingles long, key_a long, key_b long, sketch array<long>")
    pairs = spark.createDataFrame([(4, 0), (4, 1), (2, 1), (3, 0), (2, 2)], "a long, b long")
    seen = []
    release = partenum.release
    monkeypatch.setattr(partenum, "release", lambda t: seen.append(sorted(map(tuple, t.collect()))) or release(t) if t in kept else release(t))
    found = partenum._verified(table, sets, pairs, how, 80)
    assert sorted(map(tuple, found.collect())) == [(2, 2), (4, 0)] and seen == [[(2, 2), (4, 0)]]


def test_words_of_one_structure_differ(spark):
    """Two words that a polynomial hash modulo a power of two cannot tell apart."""
    one, two = thue_morse("a", "b", 1024), thue_morse("b", "a", 1024)
    rows = partenum.jaccard_components(docs(spark, [f"x {one} y", f"x {two} y"]), q=4, percent=85).collect()
    assert sorted(r.component_id for r in rows) == [0, 1]
    filler = " ".join(WORDS[:49])
    assert {r.n_removed for r in recompression.removed_words(docs(spark, [f"{one} {filler}", f"{two} {filler}"])).collect()} == {0}


#: Pairs of words that the unkeyed 64-bit hash of words cannot tell apart.
ALIKE = (("peoycdx", "':8=fpw}"), ("kqsorrw", '^wa9={b"'))


@pytest.mark.parametrize("pair", ALIKE)
def test_words_made_to_collide(spark, pair):
    from cartoscope.llm.text_hash import Texts

    raw = " ".join(pair).encode()
    plain = Texts(np.arange(1), np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), False)
    keyed = Texts(np.arange(1), np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), False, keys=text_hash.draw_keys())
    assert len(set(plain.hash.tolist())) == 1 and len({*keyed.hash.tolist(), *keyed.second.tolist()}) == 4
    rows = partenum.jaccard_components(docs(spark, list(pair)), q=4, percent=85).collect()
    assert sorted(r.component_id for r in rows) == [0, 1]
    texts = [" ".join([*WORDS[:26], w, *WORDS[26:60]]) for w in pair]
    assert {r.n_removed for r in recompression.removed_words(docs(spark, texts)).collect()} == {0}


def test_components_of_any_size(spark):
    """Squares of these components overflow, or vanish."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(4, 6))
    vectors = [b * s for b in base for s in (1e200, 1e-200, 1.0, 5e-320)]
    df = spark.createDataFrame([(i, "a", [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in flat_graph.near_duplicates(df, threshold=0.98).collect()}
    assert got == {i: (3, i // 4 * 4) for i in range(16)}


def test_a_long_text_does_not_end_the_sample(spark, monkeypatch):
    """Wherever it stands in the order of hashes, texts behind it that fit are learnt from."""
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: fitted.append(sorted(len(t) for t in texts)))
    texts = ["a b c " * 10 for _ in range(60)]
    for long in range(60):
        some = [t if i != long else "x " * 3000 for i, t in enumerate(texts)]
        if long in (0, 7, 21, 40):
            labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
            toxicity.learn(docs(spark, some), labels, limit_bytes=5000)
    assert len(fitted) == 4 and all(len(sizes) >= 30 and max(sizes) == 60 for sizes in fitted)


def test_large_ids_beside_a_null_id(spark):
    body = " ".join(WORDS[:60])
    big = 2**60
    rows = partenum.jaccard_components(docs(spark, [body, f"{body} tail", "other words of a text"], [big + 1, big + 3, None]), q=4, percent=85).collect()
    assert {r.doc_id: r.component_id for r in rows} == {big + 1: big + 1, big + 3: big + 1, None: None}


def test_ids_with_several_texts(spark):
    a, b, c = (" ".join(WORDS[k : k + 60]) for k in (0, 100, 200))
    rows = partenum.jaccard_components(docs(spark, [a, b, a, f"{b} tail", c, c], [1, 5, 5, 7, 3, 5]), q=4, percent=85).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (3, 1), (5, 1), (5, 1), (5, 1), (7, 1)]


def test_near_but_unlike_group(spark):
    """Copies of one body with words of their own: some pairs link, most do not, and one body is long."""
    rng = np.random.default_rng(12)
    texts = []
    for n, edits in ((150, 6), (150, 2), (40, 1), (600, 12)):
        body = random_text(rng, n).split()
        for k in range(25):
            w = list(body)
            for at in rng.choice(n, edits, replace=False):
                w[at] = f"own{k}{at}"
            texts.append(" ".join(w))
    sets = [shingles(t, 4) for t in texts]
    root = list(range(len(sets)))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: r.component_id for r in partenum.jaccard_components(docs(spark, texts), q=4, percent=85).collect()}
    assert got == dict(enumerate(root)) and 1 < len(set(root)) < len(root)


def test_jaccard_edge_rows(spark):
    rows = partenum.jaccard_components(docs(spark, ["a b c d e", "a b c d e", None, "x", "a b c d e"], [5, 5, 7, None, 2]), q=4, percent=85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == sorted([("5", 2, "2"), ("5", 2, "2"), ("7", 0, "7"), ("None", 1, "None"), ("2", 2, "2")])
    assert partenum.jaccard_components(docs(spark, [])).collect() == []
    kept = partenum.keep_one(docs(spark, ["a b c d e f", "a b c d e f", "z"])).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2] and kept[0].sig == "x"


def without_repeats(texts, ids, width):
    words = {i: (t or "").encode().split() for i, t in zip(ids, texts)}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k : k + width]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_removed_words(spark, mixed):
    expected = {i: (n, g, hashlib.sha256(k).hexdigest()) for i, (n, g, k) in without_repeats(mixed, range(len(mixed)), 50).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in recompression.removed_words(docs(spark, mixed)).collect()}
    assert got == expected
    assert sum(v[1] for v in got.values()) > 0


def test_drop_repeats(spark, mixed):
    kept = without_repeats(mixed, range(len(mixed)), 50)
    out = {r.doc_id: r for r in recompression.drop_repeats(docs(spark, mixed), chars_col="n_chars").collect()}
    for i, (n, g, k) in kept.items():
        if g and not k:
            assert i not in out
        else:
            assert out[i].text == (k.decode() if g else mixed[i]) and out[i].name == "y"
            assert not g or out[i].n_chars == len(k.decode())
    assert recompression.removed_words(docs(spark, [])).collect() == []


def test_equal_windows_have_equal_anchors():
    from cartoscope.llm.text_hash import Texts

    rng = np.random.default_rng(8)
    body = [random_text(rng, 200), "b " * 160, "ab cd " * 90]
    for text in body:
        names = []
        for k in range(6):
            raw = f"{random_text(rng, int(rng.integers(0, 40)))} {'b ' * k}{text} {random_text(rng, 30)}".encode()
            x = recompression.anchors(Texts(np.arange(1), np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), False), 50)
            each = np.repeat(x["name"], x["count"])
            names.append(dict(zip(x["hash"].tolist(), each.tolist())))
        for a in names:
            for h in a.keys() & names[0].keys():
                assert a[h] == names[0][h]


def test_pieces_agree_with_the_library(spark):
    import sentencepiece

    path = queries.model_file()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, " ", "  two  spaces ", "▁mark ▁▁", "tab\tnew\nline", "é 😀 \x00 z", "<s> </s> <unk>", "a" * 3000, "word " * 4000, "日本語 テキスト"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in pieces.encode_decode(docs(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        ids = model.encode(t or "", add_eos=True)
        assert (got[i].n_tokens, got[i].ids, got[i].decoded) == (len(ids), ids, model.decode(ids))


def test_jpeg_round_trip(spark):
    texts = ["", None, "x", "é" * 700, "long " * 20_000]
    media = progressive_jpeg.store(docs(spark, texts))
    rows = {r.doc_id: r for r in progressive_jpeg.read(media).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert rows[i].payload == raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw)) and rows[i].n_bytes == len(raw)
        assert len(rows[i].rgb) == rows[i].height * rows[i].width * 3


def test_jpeg_scans_bit_by_bit():
    """The whole-array decoders agree with a plain bit-by-bit reading, also with zeros, runs and new coefficients."""
    payload = bytes(range(256)) * 9
    media = progressive_jpeg.encode(payload[:576], 576)
    planes, *_ = progressive_jpeg.coefficients(media)
    codes = progressive_jpeg._Codes(progressive_jpeg.AC_BITS, progressive_jpeg.AC_SYMBOLS)
    # the same first scan, read by the loop for scans of any code lengths
    block = np.frombuffer(payload[:576], np.uint8).reshape(-1, 48)[:1, :16]
    bits = np.concatenate([np.r_[[0], progressive_jpeg._bits(int(v) >> 1, 7)] for v in block[0]]).astype(np.uint8)
    padded = np.packbits(np.r_[bits, np.zeros(8, np.uint8)])
    band = np.zeros((1, 16), np.int32)
    progressive_jpeg._ac_first(band, codes, padded, 1)
    assert (np.abs(band[0]) == np.abs(planes[0][0, 1:17]) // 2 * 2).all()
    # refinement with a zero in the band: one correction bit, one new coefficient, then an end of band
    table = progressive_jpeg._Codes(bytes([0, 2, 0, 0] + [0] * 12), bytes([0x01, 0x00]))
    band = np.array([[4, 0, -4, 0]], np.int32)
    progressive_jpeg._ac_refine(band, table, np.packbits(np.array([0, 0, 1, 1, 0, 1, 1], np.uint8)), 0)
    assert band.tolist() == [[5, 1, -5, 0]]


def test_idct_matches_definition():
    rng = np.random.default_rng(3)
    c = rng.normal(size=64)
    full = np.zeros((8, 8))
    for k, i in enumerate(progressive_jpeg.ZIGZAG):
        full[i // 8, i % 8] = c[k]
    a = lambda k: np.sqrt(0.5) if k == 0 else 1.0
    want = [[sum(a(u) * a(v) / 4 * full[u, v] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) for y in range(8)] for x in range(8)]
    assert np.allclose(c.astype(np.float32) @ progressive_jpeg.IDCT, np.ravel(want), atol=1e-4)


def test_toxicity_on_held_out_texts(spark):
    table = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    rows = toxicity.score(table("documents"), table("labels")).join(table("labels"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    test = [r for r in rows if r.held_out]
    pos, neg = [r.score for r in test if r.toxic == 1], [r.score for r in test if r.toxic == 0]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.8
    assert sum(n >= 0.7 for n in neg) <= 0.03 * len(neg)


def test_toxicity_edges(spark):
    rng = np.random.default_rng(4)
    texts = [random_text(rng, 120) + (" vile" if i % 4 == 0 else "") for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    frame = docs(spark, [*texts, None, "", "!!", "w1 " * 30_000], [*range(120), 200, 201, 202, None])
    rows = toxicity.score(frame, labels).collect()
    assert len(rows) == 124 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (200, 201, 202)}) == 1
    assert toxicity.score(docs(spark, []), labels).collect() == []
    assert {r.score for r in toxicity.score(docs(spark, ["a"]), labels.limit(0)).collect()} == {0.0}


def test_gradients():
    """Backpropagation against finite differences."""
    rng = np.random.default_rng(2)
    h = toxicity.HIDDEN
    w = {k: rng.normal(size=s) for k, s in {"u0": (h, 3 * h), "u1": (h, 3 * h), "attend": (2 * h,), "out": (2 * h,), "bias": (1,)}.items()}
    x, mask = rng.normal(size=(5, 3, 6 * h)), np.ones((5, 3, 1))
    mask[3:, 1] = 0
    keep: dict = {}
    toxicity._forward(w, x, mask, keep)
    grads, dx = toxicity._gradients(w, mask, keep, np.ones(3))
    loss = lambda: toxicity._forward(w, x, mask).sum()
    for name, at in (("u0", (1, 2)), ("u1", (3, 2 * h + 1)), ("attend", (5,)), ("out", (2,))):
        w[name][at] += 1e-6
        up = loss()
        w[name][at] -= 2e-6
        down = loss()
        w[name][at] += 1e-6
        assert np.isclose((up - down) / 2e-6, grads[name][at], atol=1e-4)
    x[1, 1, 3] += 1e-6
    up = loss()
    x[1, 1, 3] -= 2e-6
    assert np.isclose((up - loss()) / 2e-6, dx[1, 1, 3], atol=1e-4)


def test_near_duplicate_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 16))
    x = np.vstack([x, x[:20] + rng.normal(size=(20, 16)) * 0.05, x[:10], np.repeat(x[:1], 15, 0) + rng.normal(size=(15, 16)) * 0.03])
    rows = [(i, [float(v) for v in r], int(i % 3 > 0), "c") for i, r in enumerate(x)]
    rows += [(900, None, 0, "c"), (901, [0.0] * 16, 0, "c"), (902, [float("nan")] * 16, 0, "c"), (903, [float(v) for v in x[0]], None, "c"), (904, [None] * 16, 0, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")
    f = {i: (np.asarray(r, np.float32).astype(float), l) for i, r, l, _ in rows if i < 900}
    links = collections.defaultdict(set)
    for i, (a, l) in f.items():
        for j, (b, m) in f.items():
            if i != j and l == m and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.98:
                links[i].add(j)
    root = {i: i for i, *_ in rows}
    for _ in range(50):
        for i in links:
            for j in links[i]:
                root[i] = root[j] = min(root[i], root[j])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in flat_graph.near_duplicates(df).collect()}
    assert got == {i: (len(links[i]), root[i], root[i] == i) for i in root}
    assert flat_graph.near_duplicates(df.limit(0)).collect() == []


def test_oversized_shards_are_cut(spark, monkeypatch):
    """Shards over the limit, and a group of near copies that no pivot cuts, give the same links."""
    rng = np.random.default_rng(10)
    x = np.vstack([rng.normal(size=(150, 8)), rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * 0.02])
    df = spark.createDataFrame([(i, [float(v) for v in r], 1) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98).sum(1) - 1
    monkeypatch.setattr(flat_graph, "SHARD", 40)
    got = {r.vec_id: r.n_links for r in flat_graph.near_duplicates(df).collect()}
    assert sum(min(got[i], n) for i, n in enumerate(near)) >= 0.9 * near.sum()
    assert all(got[i] <= n for i, n in enumerate(near))


def clumps():
    """Clumps of 130 and 100 vectors, far tighter than the distance between them, which is within the threshold; the first holds the medoid."""
    rng = np.random.default_rng(12)
    a, b = np.zeros(16), np.zeros(16)
    a[0], b[:2] = 1, (0.985, np.sqrt(1 - 0.985**2))
    return np.vstack([c + rng.normal(size=(n, 16)) * 1e-4 for c, n in ((a, 130), (b, 100))])


def vectors(spark, x, label=1, start=0):
    return spark.createDataFrame([(start + i, [float(v) for v in r], label) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")


def test_clumps_within_the_threshold_are_linked(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "TARGET", 0.0)  # by the graph alone
    got = flat_graph.near_duplicates(vectors(spark, clumps())).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(229, 0)}


def test_labels_below_the_target_are_compared_exactly(spark, monkeypatch):
    """No pair is found by the graph; one label is dealt as blocks."""
    rng = np.random.default_rng(13)
    x = np.vstack([rng.normal(size=(60, 8)), rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * 0.05])
    near = [(u @ u.T >= 0.98).sum(1) - 1 for u in (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, x[:30]))]
    monkeypatch.setattr(flat_graph, "SHARD", 40)
    monkeypatch.setattr(flat_graph, "_linked", lambda classes, *a: classes.select("rep", F.lit(0).cast("long").alias("links"), F.col("rep").alias("root")))
    got = {r.vec_id: r for r in flat_graph.near_duplicates(vectors(spark, x).unionByName(vectors(spark, x[:30], 2, 500))).collect()}
    assert [got[i].n_links for i in range(120)] == near[0].tolist() and [got[500 + i].n_links for i in range(30)] == near[1].tolist()
    assert len({got[i].component_id for i in range(60, 120) if got[i].n_links}) == 1


def test_url_rules(spark):
    urls = [None, "", "nohost", "http://com", "http://COM/", "http://a.com/x", "http://Example.com/en/1", "https://b.example.com/en/", "https://www.example.com/en/9?x", "http://x.net/es/1", "http://net/fr/", "http://anet/fr/1", "http://spam-farm.org/en/", "x://a://b/c#d", "http://a..com/", "http://ok.org"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    got = {r.page_id: r for r in bloom_cascade.judge(pages, keys(*queries.ALLOW), keys(*queries.BLOCK), keys("spam-farm.org"), [1, 4]).collect()}
    rules = [(r, "allow") for r in queries.ALLOW] + [(r, "block") for r in queries.BLOCK]
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = m[1].lower(), m[2]
        fits = [(len(r), r, v) for r, v in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule, verdict = max(fits)[1:] if fits else (None, "block" if host == "spam-farm.org" else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u


@pytest.mark.parametrize("small", [False, True])
def test_cascade_is_exact(spark, monkeypatch, small):
    """Several levels and several slices."""
    monkeypatch.setattr(bloom_cascade, "KEY_BITS", 3)
    if small:
        monkeypatch.setattr(bloom_cascade, "SLICE_BITS", 2000)
    universe = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("cast(key as int) % 7 = 0")
    c = bloom_cascade.build(listed, universe)
    assert len(c.bits) > 2 and (c.slices > 1) == small
    out = c.beside(universe, F.col("key")).select("key", c.contains(F.col("key")).alias("in")).collect()
    assert len(out) == 4000 and all(r["in"] == (int(r.key) % 7 == 0) for r in out)


def test_sliced_rules(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    args = (pages, keys(*queries.ALLOW), keys(*queries.BLOCK), keys("spam-farm.example.org"), [1, 4])
    whole = sorted(map(tuple, bloom_cascade.judge(*args).collect()), key=str)
    monkeypatch.setattr(bloom_cascade, "SLICE_BITS", 30)
    assert sorted(map(tuple, bloom_cascade.judge(*args).collect()), key=str) == whole


def test_license_places(spark):
    texts = [None, "", "CC BY 4.0", "cc-by, all RIGHTS reserved. All rights reserved", "the GNU General Public License", "general public", "rights reserved all", "éCC BY", "all rights reserved " * 5000, "MIT License", "cc by"]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        starts, labels = [], set()
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            found = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            starts += found
            labels |= {label} if found else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))), t
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert got[9].labels == "mit" and got[9].score > 0
    assert license_scan.scan(docs(spark, [])).collect() == []


def test_mix_keeps_budgets(spark):
    rng = np.random.default_rng(11)
    texts = [random_text(rng, 20) for _ in range(900)] + [None, ""]
    rows = [(i, t, "big" if i < 700 else "mid" if i < 870 else "small" if i < 900 else None, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    picks = mixing.mix(df, target_entropy=0.95, max_repeats=4.0).collect()
    size, got, weight = collections.Counter(), collections.Counter(), {}
    for i, t, s, _ in rows:
        size[s] += len((t or "").split())
    each = collections.Counter()
    for p in picks:
        got[p.source] += p.n_tokens
        weight[p.source] = p.weight
        each[p.doc_id, p.epoch] += 1
    total = sum(size.values())
    assert max(each.values()) == 1
    for s in ("big", "mid", "small"):
        assert weight[s] * total - 20 <= got[s] <= weight[s] * total and weight[s] * total <= 4 * size[s] + 20
    p = np.array([weight[s] for s in ("big", "mid", "small")])
    shares = np.array([size[s] / total for s in ("big", "mid", "small")])
    a = np.log(p[0] / p[1]) / np.log(shares[0] / shares[1])
    assert np.allclose(shares**a / (shares**a).sum(), p, atol=1e-6)
    h = -(p * np.log(p)).sum() / np.log(3)
    assert h >= 0.95 - 1e-6 or np.isclose((p * total / np.array([size[s] for s in ("big", "mid", "small")])).max(), 4, atol=1e-3)
    for epoch in range(int(max(p.epoch for p in picks if p.source == "small"))):
        assert sum(p.epoch == epoch for p in picks if p.source == "small") == 30
    assert mixing.mix(df.limit(0)).collect() == []
    assert set(mixing.mixed_documents(df).columns) == set(df.columns)


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 0, "search", '{"query": "é\\n", "limit": 3}', []),
            (1, "b", 2, "lookup", '{"key": 500}', ["a"]),
            (1, "c", 4, "count", '{"unit": "words", "items": [1, 2]}', ["a", "b", "gone"]),
            (1, "d", 6, "lookup", '{"key": "x"}', ["e"]),
            (1, "e", 7, "what", "{}", ["d"]),
            (1, "a", 9, "search", "{", []),
            (2, "a", 0, "search", None, None),
            (None, "z", 0, "search", "{}", []),
        ],
        "conv long, call_id string, turn long, name string, arguments string, depends_on array<string>",
    )
    results = spark.createDataFrame([(1, "a", 1, "r1"), (1, "a", 3, "r2"), (1, "q", 5, "lost")], "conv long, call_id string, turn long, content string")
    got = {(r.conv, r.call_id, r.kind): r for r in tool_calls.format_calls(calls, results, queries.SCHEMAS).collect()}
    assert {k: v.level for k, v in got.items() if k[2] == "call"} == {(1, "a", "call"): 0, (1, "b", "call"): 1, (1, "c", "call"): 2, (1, "d", "call"): None, (1, "e", "call"): None, (2, "a", "call"): 0, (None, "z", "call"): None}
    a = got[1, "a", "call"]
    assert (a.valid, a.linked, a.n_repeats, a.message) == (True, True, 1, '{"arguments":{"limit":3,"query":"é\\n"},"id":"a","level":0,"name":"search","result":"r1","role":"assistant"}')
    assert got[1, "c", "call"].n_missing == 1 and got[1, "d", "call"].errors == "type:key" and got[1, "e", "call"].errors == "tool" and got[2, "a", "call"].errors == "json"
    assert json.loads(got[1, "q", "result"].message)["content"] == "lost"
    assert tool_calls.format_calls(calls.limit(0), results.limit(0), queries.SCHEMAS).collect() == []


def test_levels_are_longest_paths(spark):
    """A long chain, a loop with calls behind it, and random dependencies, against plain recursion."""
    rng = np.random.default_rng(15)
    deps = {("chain", f"c{i}"): [f"c{i - 1}"] if i else [] for i in range(70)}
    deps |= {("loop", a): [b] for a, b in (("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"))} | {("loop", "f"): ["e", "free"], ("loop", "free"): []}
    for conv in ("x", "y"):
        for i in range(40):
            deps[conv, f"r{i}"] = [f"r{j}" for j in rng.choice(i, min(i, int(rng.integers(0, 4))), replace=False)] + (["absent"] if i % 9 == 0 else [])

    def level(conv, call, behind=()):
        if call in behind:
            return None
        below = [level(conv, d, (*behind, call)) for d in deps[conv, call] if (conv, d) in deps]
        return None if None in below else 1 + max(below, default=-1)

    calls = spark.createDataFrame([(*k, v) for k, v in deps.items()], "conv string, call_id string, depends_on array<string>")
    got = {(r.conv, r.call_id): (r.level, r.n_missing) for r in tool_calls.levels(calls).collect()}
    assert got == {(c, k): (level(c, k), sum((c, d) not in deps for d in v)) for (c, k), v in deps.items()}


def test_arguments_that_are_not_json(spark):
    texts = ['{"query": "\\ud800"}', "[" * 100_000, '{"query": NaN}', '{"query": 1e999}', '{"query": Infinity}', '{"limit": ' + "9" * 5000 + "}", '{"query": "ok"}']
    calls = spark.createDataFrame([(1, str(i), i, "search", t, []) for i, t in enumerate(texts)], "conv long, call_id string, turn long, name string, arguments string, depends_on array<string>")
    none = spark.createDataFrame([], "conv long, call_id string, turn long, content string")
    rows = {int(r.call_id): r for r in tool_calls.format_calls(calls, none, {"search": {"properties": {"query": {"enum": ["ok"]}}}}).collect()}
    assert [rows[i].errors for i in range(len(texts))] == ["json"] * 6 + [""]
    assert all(json.loads(rows[i].message)["arguments"] == texts[i] for i in range(6))


def test_every_tool_result_is_kept(spark):
    calls = spark.createDataFrame([(1, "a", 0, "search", "{}", []), (1, "b", 0, "search", "{}", [])], "conv long, call_id string, turn long, name string, arguments string, depends_on array<string>")
    told = [(1, "a", 1, "x"), (1, "a", 1, "x"), (1, "a", 2, "y"), (1, "b", None, None), (1, "q", 1, "x"), (1, "q", 1, "x"), (1, "q", 3, None), (None, "a", 1, "x"), (None, "a", 2, "y"), (1, None, 1, "x"), (1, None, 1, "x"), (None, None, None, None)]
    results = spark.createDataFrame(told, "conv long, call_id string, turn long, content string")
    rows = tool_calls.format_calls(calls, results, queries.SCHEMAS).collect()
    assert sorted((r.call_id, r.linked, json.loads(r.message)["result"]) for r in rows if r.kind == "call") == [("a", True, "x"), ("b", True, None)]
    got = collections.Counter((r.conv, r.call_id, r.turn, json.loads(r.message)["content"]) for r in rows if r.kind == "result")
    assert got == collections.Counter(told) - collections.Counter([told[0], told[3]])


def test_registered_sql(spark):
    from tests import oracle

    con = oracle.connection()
    for name, sql in queries.oracle_sql().items():
        columns, rows = oracle.rows_of(queries.queries()[name](spark, oracle.SF))
        expected_columns, expected = oracle.sql_rows(con, sql)
        assert columns == expected_columns and oracle.same(rows, expected), name


def test_stages(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs_now = documents
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs_now = stage(spark, docs_now, SF).persist()
        assert docs_now.columns == documents.columns, name
        sizes.append(docs_now.count())
    assert documents.count() > sizes[0] > 0 and sizes[1] < sizes[0] and sizes[2] <= sizes[1]
    out = corpus_pipeline.STAGES[4][1](spark, docs_now, SF)
    assert out.count() == sizes[3]


def test_media_digests(spark):
    """The query's columns, recomputed from the texts and the stored files; nulls, repeated ids and an empty table."""
    texts = ["", None, "a" * 575, "b" * 576, "c" * 577, "é" * 400, "a" * 575, "long " * 3000]
    frame = docs(spark, texts, [0, 1, 2, 3, 4, 5, None, 2])
    stored = progressive_jpeg.store(frame)
    media = collections.defaultdict(list)
    for r in stored.collect():
        media[r.doc_id].append(bytes(r.media))
    rows = progressive_jpeg.read(stored, tensors=False).collect()
    assert len(rows) == len(texts)
    raw = collections.defaultdict(set)
    for i, t in zip([0, 1, 2, 3, 4, 5, None, 2], texts):
        b = (t or "").encode()
        full = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        raw[i].add((len(b), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:])))
    for r in rows:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) in raw[r.doc_id]
        assert (r.media_bytes, r.media_sha256) in {(len(m), hashlib.sha256(m).hexdigest()) for m in media[r.doc_id]}
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].feature == by_id[1].feature and by_id[None].media_sha256 in {hashlib.sha256(m).hexdigest() for m in media[2]}
    assert progressive_jpeg.read(progressive_jpeg.store(docs(spark, [])), tensors=False).collect() == []


def test_piece_digests(spark):
    """The query's columns against the library on whole texts; nulls, repeated and null ids, and an empty table."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.model_file())
    texts = [None, "", " ", "  two  spaces ", "▁mark ▁▁ x▁y", "tab\tline\n\nend", "éßﬁ ①", "word " * 5000, "\u3000wide", "<s> </s> <unk>"] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    ids = [None, None, *range(len(texts) - 3), 3]
    got = collections.Counter(tuple(r) for r in pieces.encode_decode(docs(spark, texts, ids), queries.model_file(), end=True, digests=True).collect())
    want = collections.Counter()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in zip(ids, texts):
        x = model.encode(t or "", add_eos=True)
        want[i, len(x), sha(" ".join(map(str, x))), sha(model.decode(x))] += 1
    assert got == want
    assert pieces.encode_decode(docs(spark, []), queries.model_file(), digests=True).collect() == []


def test_license_labels_and_score(spark):
    """Labels and score of every document by plain search."""
    rows = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [None, "", "MIT License; Apache License, version 2.0", "MIT License", "mit license"]
    ids = [*range(len(rows) - 2), None, len(rows) - 3]
    words = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in rows]
    templates = [(p.split(), label) for p, label in (*license_scan.BASE, *license_scan.MORE)]
    df = {w: sum(w in set(x) for x in words) for p, _ in templates for w in p}
    got = collections.Counter((r.doc_id, r.n_words, r.labels, r.score) for r in license_scan.scan(docs(spark, rows, ids)).collect())
    want = collections.Counter()
    for i, x in zip(ids, words):
        found = [(p, label) for p, label in templates if any(x[k : k + len(p)] == p for k in range(len(x)))]
        miss = 1.0
        for p, _ in found:
            rarest = min(range(len(p)), key=lambda k: (df[p[k]], -len(p[k]), k))
            miss *= 1 - 0.9 * (1 - df[p[rarest]] / len(rows))
        want[i, len(x), ",".join(sorted({label for _, label in found})), round(1 - miss, 6)] += 1
    assert {k[:3]: v for k, v in got.items()} == {k[:3]: v for k, v in want.items()}
    assert all(min(abs(g[3] - w[3]) for w in want if w[:3] == g[:3]) < 2e-6 for g in got)


def test_repeated_rows_share_their_picks(spark):
    """mixed_documents() gives as many rows as there are picks, evenly to the rows of an id; null ids and clashing columns."""
    rng = np.random.default_rng(21)
    texts = [random_text(rng, 30) for _ in range(60)]
    ids = [*range(40), *[7] * 5, *[None] * 15]
    frame = docs(spark, texts, ids).withColumnRenamed("key", "__times").withColumnRenamed("level0", "salt").withColumnRenamed("sig", "picks")
    picks = collections.Counter(r.doc_id for r in mixing.mix(frame).collect())
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    rows = [(r.doc_id, r.text) for r in out.collect()]
    assert collections.Counter(i for i, _ in rows) == picks
    for i in (7, None):
        each = [sum(r == (i, t) for r in rows) for j, t in zip(ids, texts) if j == i]
        assert max(each) - min(each) <= 1 and sum(each) == picks[i]


def test_mix_by_plain_recount(spark):
    """Weights and picks of the query on the given documents, recomputed in Python."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(frame, target_entropy=0.95, max_repeats=4.0).collect()
    docs_of = {r.doc_id: (r.source, len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))) for r in frame.collect()}
    size = collections.Counter()
    for s, n in docs_of.values():
        size[s] += n
    total, names = sum(size.values()), sorted(size)
    share = np.array([size[s] / total for s in names])

    def at(a):
        w = share**a / (share**a).sum()
        return w, -(w * np.log(w)).sum()

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if at(mid)[1] >= 0.95 * np.log(len(names)) else (low, mid)
    weight = dict(zip(names, at(1.0 if at(1.0)[1] >= 0.95 * np.log(len(names)) else low)[0]))
    found = {r.source: r.weight for r in got}
    assert (at(low)[0] / share).max() <= 4  # the limit of repeats plays no part here
    assert all(abs(found[s] - weight[s]) < 1e-6 for s in names)
    tokens, seen = collections.Counter(), collections.Counter()
    for r in got:
        assert (r.source, r.n_tokens) == docs_of[r.doc_id]
        tokens[r.source] += r.n_tokens
        seen[r.source, r.epoch, r.doc_id] += 1
    assert max(seen.values()) == 1
    longest = {s: max(n for t, n in docs_of.values() if t == s) for s in names}
    assert all(weight[s] * total - longest[s] - 1 <= tokens[s] <= weight[s] * total + 1 for s in names)


def test_only_texts_go_to_python(spark):
    """drop_toxic() sends a text once and gets a number back; no whole row goes to Python and back again."""
    frame = docs(spark, ["a b", "c d"])
    plan = toxicity.drop_toxic(frame, spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_rows_are_judged_by_their_own_text(spark):
    """drop_toxic() and drop_repeats() with null and repeated ids, ties, an empty table and clashing names."""
    rng = np.random.default_rng(4)
    texts = [random_text(rng, 120) + (" vile" * 6 if i % 4 == 0 else "") for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    frame = docs(spark, [*texts, texts[0], texts[1], texts[0], None, ""], [*range(120), 500, 500, None, 501, 502])
    net = toxicity.learn(frame, labels)
    plain = toxicity.batch_scores(__import__("pyarrow").array([r.text for r in frame.collect()]), net)
    kept = collections.Counter((r.doc_id, r.text) for r in toxicity.drop_toxic(frame, labels).collect())
    assert kept == collections.Counter((r.doc_id, r.text) for r, s in zip(frame.collect(), plain) if s < 0.7)
    assert (500, texts[1]) in kept and (500, texts[0]) not in kept and (None, texts[0]) not in kept
    assert toxicity.drop_toxic(docs(spark, []), labels).collect() == []
    passage = " ".join(WORDS[:60])
    frame = docs(spark, [f"{passage} one", f"two {passage}", "three words here", f"{passage} four", None, passage], [1, 5, 5, None, 6, 7])
    out = collections.Counter((r.doc_id, r.text) for r in recompression.drop_repeats(frame, chars_col="n_chars").collect())
    assert out == collections.Counter([(1, f"{passage} one"), (5, "two"), (5, "three words here"), (None, f"{passage} four"), (6, None)])
    assert recompression.drop_repeats(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        recompression.removed_words(frame, width=64)


def test_window_scan(spark):
    """Logits of all windows of a text against a loop over its windows, one at a time."""
    rng = np.random.default_rng(8)
    texts = [random_text(rng, int(n)) + (" vile" if k % 3 == 0 else "") for k, n in enumerate(rng.integers(1, 200, 80))]
    net = toxicity.fit(texts, np.array([int(k % 3 == 0) for k in range(80)]))
    for text in texts[:12]:
        whole = toxicity.text_features(toxicity.sample([text]), net)[0]
        words = text.split()
        starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        one = [toxicity.text_features(toxicity.sample([" ".join(words[s : s + toxicity.WINDOW])]), net)[0, 1] for s in starts]
        assert np.isclose(whole[1], max(one), atol=1e-4) and np.isclose(np.expm1(whole[2]), sum(1 / (1 + np.exp(-z)) for z in one), atol=1e-4)


def test_mixed_rows_follow_the_plan(spark, monkeypatch):
    """Rows come as often as mix() picks their ids; only ids of several rows and of blocks at the ends are looked up by id."""
    monkeypatch.setattr(mixing, "BLOCKS", 8)
    rng = np.random.default_rng(8)
    table = docs(spark, [random_text(rng, int(n) * (1 if k % 3 else 9)) for k, n in enumerate(rng.integers(1, 30, 300))], [*range(298), 5, 5])
    kept, durable = {}, mixing.durable
    monkeypatch.setattr(mixing, "durable", lambda df, label: kept.setdefault(label, durable(df, label)))
    want = collections.Counter(r.doc_id for r in mixing.mix(table).collect())
    kept.clear()
    assert collections.Counter(r.doc_id for r in mixing.mixed_documents(table).collect()) == want
    assert 1 < kept["times"].count() < 150
