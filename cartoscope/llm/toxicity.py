"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs are word embeddings (words that tell the classes of the fitting sample apart) and character embeddings (hashed
character trigrams of every word, so unknown words have a vector too). Overlapping windows of words
go through two gated recurrent layers, one in each direction; attention pools their states to one
logit a window. A text's score is a calibrated logistic of the largest window logit and of the logarithm of
the expected number of toxic windows. Everything is numpy: the network is fitted by backpropagation on a bounded
sample of labelled texts, and scores all overlapping windows of all whole texts inside Spark tasks.

Defined results: null and empty texts and texts without words have no window and the score of
the sample's base rate. Rows with a null id are scored. Repeated rows are scored each. With no
labelled rows of both classes every score is 0; of an id with several labels the largest counts, with several texts the
smallest is learnt from. drop_toxic() judges every row by its own text, also where ids are null or repeated. Texts of any length are scored whole. Only text_col is an
input of a score; extra columns are ignored by score() and kept by drop_toxic().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.llm.text_hash import LOWER, SEPARATORS, Texts, U, chunks

WINDOW, STRIDE = 48, 32
HIDDEN, WORD_DIM, CHAR_DIM, CHAR_BUCKETS = 8, 8, 4, 4096
#: Labelled texts to fit on, at most, their bytes, at most, and words in the table, at most: the only bounds, whatever the input.
FIT_TEXTS, FIT_BYTES, TABLE_WORDS, CHI = 3000, 12 << 20, 512, 15.0
EPOCHS, BATCH, RATE, TABLE_RATE, DECAY, SUSPECT = 5, 32, 0.03, 0.01, 0.1, 0.4
PARTS = 2048  # windows scored together


@dataclass
class Network:
    """Fitted weights; words holds the sorted hashes of the words in the table."""

    words: np.ndarray
    weights: dict[str, np.ndarray]
    final: np.ndarray  # logistic weights of the text's features: 1, largest, number
    base: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _trigrams(texts: Texts) -> np.ndarray:
    """Bucket of the trigram around each byte."""
    d = LOWER[texts.data].astype(np.uint32)
    d[SEPARATORS[texts.data]] = 0
    before, after = np.r_[np.uint32(0), d[:-1]], np.r_[d[1:], np.uint32(0)]
    x = before * np.uint32(0x9E3779B1) + d * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)


def _word_ids(net_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of each word in the table; the row behind the last for other words."""
    at = np.searchsorted(net_words, hashes)
    return np.where((at < len(net_words)) & (net_words[np.minimum(at, len(net_words) - 1)] == hashes), at, len(net_words)) if len(net_words) else np.zeros(len(hashes), np.int64)


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows: text, first word, length. at: of text i the words at[i]:at[i + 1]."""
    n = np.diff(at)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(n)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = at[text] + step * STRIDE
    return text, first, np.minimum(WINDOW, at[text + 1] - first)


def _direction(x: np.ndarray, u: np.ndarray, mask: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
    """States (time, batch, hidden) of one gated recurrent layer. x: (time, batch, 3 * hidden) inputs of the gates."""
    time, batch, _ = x.shape
    out, h = np.empty((time, batch, HIDDEN), x.dtype), np.zeros((batch, HIDDEN), x.dtype)
    for t in range(time - 1, -1, -1) if back else range(time):
        hu = h @ u
        gates = x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN]
        np.negative(gates, out=gates)
        np.exp(np.minimum(gates, 30, out=gates), out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        r, z, hn = gates[:, :HIDDEN], gates[:, HIDDEN:], hu[:, 2 * HIDDEN :]
        n = np.tanh(x[t, :, 2 * HIDDEN :] + r * hn)
        new = (n + z * (h - n)) if mask is None else h + mask[t] * ((n + z * (h - n)) - h)
        if keep is not None:
            keep.append((t, r, z, n, hn, h))
        out[t] = h = new
    return out


def _forward(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Window logits. x: (time, batch, 6 * hidden); mask: (time, batch, 1), or None if all windows are full."""
    g = 3 * HIDDEN
    parts = [[], []] if keep is not None else [None, None]
    hs = np.concatenate([_direction(x[:, :, :g], w["u0"], mask, False, parts[0]), _direction(x[:, :, g:], w["u1"], mask, True, parts[1])], -1)
    scores = hs @ w["attend"]
    if mask is not None:
        scores = np.where(mask[:, :, 0] > 0, scores, -1e9)
    a = np.exp(scores - scores.max(0))
    a /= a.sum(0)
    pooled = (a[:, :, None] * hs).sum(0)
    if keep is not None:
        keep.update(parts=parts, hs=hs, a=a, pooled=pooled)
    return pooled @ w["out"] + w["bias"][0]


def _gradients(w: dict[str, np.ndarray], mask: np.ndarray, keep: dict, d: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the recurrent and pooling weights, and of the gates' inputs. d: of the logits."""
    hs, a, pooled = keep["hs"], keep["a"], keep["pooled"]
    grads = {"out": pooled.T @ d, "bias": np.array([d.sum()])}
    dp = d[:, None] * w["out"]
    ds = a * ((hs - pooled) * dp).sum(-1)
    grads["attend"] = np.einsum("tbh,tb->h", hs, ds)
    dh_all = a[:, :, None] * dp + ds[:, :, None] * w["attend"]
    dx = np.empty((*hs.shape[:2], 6 * HIDDEN), hs.dtype)
    for k in range(2):
        u, du, dh = w[f"u{k}"], np.zeros_like(w[f"u{k}"]), 0.0
        for t, r, z, n, hn, h in reversed(keep["parts"][k]):
            dh = dh + dh_all[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            new = dh * mask[t]
            dn = new * (1 - z) * (1 - n * n)
            dz = new * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dx[t, :, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)] = np.concatenate([dr, dz, dn], 1)
            dg = np.concatenate([dr, dz, dn * r], 1)
            du += h.T @ dg
            dh = dh * (1 - mask[t]) + new * z + dg @ u.T
        grads[f"u{k}"] = du
    return grads, dx


@dataclass
class Sample:
    """Texts as what the network reads: hash, size and first trigram of each word, trigram buckets of all words' bytes, first word of each text."""

    hash: np.ndarray
    size: np.ndarray
    start: np.ndarray
    tri: np.ndarray
    at: np.ndarray


def compact(t: Texts) -> Sample:
    size = (t.ends - t.starts).astype(np.int32)
    start = np.cumsum(size, dtype=np.int64) - size
    inside = np.arange(size.sum()) + np.repeat(t.starts - start, size)
    return Sample(t.hash, size, start, _trigrams(t)[inside].astype(np.uint16), t.at)


def sample(texts: list[str], limit: int = 1 << 20) -> Sample:
    """Texts in parts of about limit bytes, so that only the compact arrays of all of them are held."""
    hashes, sizes, tris, words = [], [], [], []
    column = pa.array([t.encode() for t in texts], pa.binary())
    for part, _, _ in chunks(pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), column], ["id", "text"]), lower=True, limit=limit, spaces=SEPARATORS):
        t = compact(part)
        hashes.append(t.hash)
        sizes.append(t.size)
        tris.append(t.tri)
        words.append(np.diff(t.at))
    size = np.concatenate(sizes)
    return Sample(np.concatenate(hashes), size, np.cumsum(size, dtype=np.int64) - size, np.concatenate(tris), np.r_[0, np.cumsum(np.concatenate(words))])


def _table(t: Sample, labels: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words whose presence tells the classes apart best (chi square), among those in enough texts, and their shrunk log-odds."""
    mine = learnt[np.repeat(np.arange(len(labels)), np.diff(t.at))]
    seen, word = np.unique(t.hash[mine], return_inverse=True)
    text = np.repeat(np.arange(len(labels)), np.diff(t.at))[mine]
    pairs = np.unique(word * len(labels) + text)  # each word once a text, packed in one key
    word, text = pairs // len(labels), pairs % len(labels)
    alls, ones = np.bincount(word, minlength=len(seen)), np.bincount(word, weights=labels[text], minlength=len(seen))
    n, n1 = int(learnt.sum()), max(1, int(labels[learnt].sum()))
    expected = alls * n1 / n
    chi = (ones - expected) ** 2 / (expected * (1 - n1 / n) * np.maximum(1 - alls / n, 1e-3) + 0.5)
    enough = (alls >= max(3, n // 200)) & (chi >= CHI)
    if enough.sum() > TABLE_WORDS:
        enough &= chi >= np.sort(chi[enough])[-TABLE_WORDS]
    lift = np.log((ones + 2 * n1 / n) / (alls - ones + 2 * (1 - n1 / n))) - np.log(n1 / max(1, n - n1))
    return seen[enough], lift[enough]


def fit(texts: list[str], labels: np.ndarray, *, seed: int = 7) -> Network | None:
    """Fit the network on whole texts with labels 0 and 1; None if a class is missing."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    t = sample(texts)
    learnt = rng.permutation(len(texts)) % 4 > 0  # the others calibrate
    if len(set(labels[learnt].tolist())) < 2 or len(set(labels[~learnt].tolist())) < 2:
        learnt = np.ones(len(texts), bool)
    words, lift = _table(t, labels, learnt)
    ids = _word_ids(words, t.hash)
    tri, size = t.tri, t.size

    def start(*shape: int, scale: float = 0.3) -> np.ndarray:
        return rng.normal(0, scale, shape)

    w = {"word": start(len(words) + 1, WORD_DIM, scale=0.1), "char": start(CHAR_BUCKETS, CHAR_DIM, scale=0.1), "wx": start(WORD_DIM, 6 * HIDDEN), "cx": start(CHAR_DIM, 6 * HIDDEN), "bx": np.zeros(6 * HIDDEN), "u0": start(HIDDEN, 3 * HIDDEN), "u1": start(HIDDEN, 3 * HIDDEN), "attend": start(2 * HIDDEN), "out": start(2 * HIDDEN), "bias": np.zeros(1)}
    # the first dimension of a word starts at its shrunk log-odds between the classes
    w["word"][:-1, 0] = np.clip(lift, -2, 4) / 2
    first_moment, second_moment = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    text, first, length = windows(t.at)
    y = labels[text].astype(float)
    positive, negative = np.flatnonzero((y == 1) & learnt[text]), np.flatnonzero((y == 0) & learnt[text])

    def inputs(b: np.ndarray) -> tuple[np.ndarray, ...]:
        cell = first[b] + np.minimum(np.arange(WINDOW)[:, None], length[b] - 1)
        mask = (np.arange(WINDOW)[:, None] < length[b]).astype(float)[:, :, None]
        distinct, back = np.unique(cell, return_inverse=True)
        spread = np.repeat(np.arange(len(distinct)), size[distinct])
        places = np.arange(len(spread)) - np.repeat(np.cumsum(size[distinct]) - size[distinct], size[distinct]) + t.start[distinct][spread]
        chars = np.zeros((len(distinct), CHAR_DIM))
        np.add.at(chars, spread, w["char"][tri[places]])
        chars /= size[distinct][:, None]
        gates = w["word"][ids[distinct]] @ w["wx"] + chars @ w["cx"] + w["bx"]
        return gates[back.reshape(cell.shape)], mask, distinct, back.ravel(), spread, places, chars

    step = 0
    for epoch in range(EPOCHS):
        chosen = positive
        if epoch:  # a toxic text's label belongs to its most suspicious windows
            z = np.concatenate([_forward(w, *inputs(positive[i : i + 512])[:2]) for i in range(0, len(positive), 512)])
            order = np.lexsort((-z, text[positive]))
            of = text[positive][order]
            head = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            many = np.diff(np.r_[head, len(of)])
            rank = np.arange(len(of)) - np.repeat(head, many)
            chosen = positive[order][rank < np.repeat(np.ceil(many * SUSPECT), many)]
        some = rng.choice(negative, min(len(negative), max(1000, 2 * len(chosen))), replace=False)
        order = rng.permutation(np.r_[chosen, some])
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            x, mask, distinct, back, spread, places, chars = inputs(b)
            keep: dict = {}
            p = _sigmoid(_forward(w, x, mask, keep))
            grads, dx = _gradients(w, mask, keep, (p - y[b]) / len(b))
            flat = np.zeros((len(distinct), 6 * HIDDEN))
            np.add.at(flat, back, dx.reshape(-1, 6 * HIDDEN))
            grads["wx"], grads["cx"], grads["bx"] = w["word"][ids[distinct]].T @ flat, chars.T @ flat, flat.sum(0)
            grads["word"], grads["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
            np.add.at(grads["word"], ids[distinct], flat @ w["wx"].T)
            np.add.at(grads["char"], tri[places], ((flat @ w["cx"].T) / size[distinct][:, None])[spread])
            step += 1
            for k, g in grads.items():
                table = k in ("word", "char")
                square = g * g
                first_moment[k] += 0.1 * (g - first_moment[k])
                second_moment[k] += 0.01 * (square - second_moment[k])
                change = first_moment[k] / (1 - 0.9**step) / (np.sqrt(second_moment[k] / (1 - 0.99**step)) + 1e-6)
                w[k] = w[k] - (TABLE_RATE if table else RATE) * (change + (DECAY if table else 1e-3) * w[k])
    net = Network(words, {k: v.astype(np.float32) for k, v in w.items()}, np.zeros(3), float(labels.mean()))
    features = np.concatenate([text_features(part, net) for part in _parts(t)])
    use = np.isfinite(features[:, 1]) & (~learnt | learnt.all())
    net.final = _logistic(features[use], labels[use].astype(float))
    return net


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ c)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(c))
        c += np.linalg.solve(h, x.T @ (y - p) - 0.1 * c)
    return c


def _parts(t: Sample, limit: int = 1 << 20) -> Iterator[Sample]:
    """Whole texts of t, about limit bytes of words at a time."""
    end = np.r_[t.start, len(t.tri)]
    i = 0
    while i < len(t.at) - 1:
        j = max(i + 1, int(np.searchsorted(end[t.at], end[t.at[i]] + limit, "right")) - 1)
        a, b = t.at[i], t.at[j]
        yield Sample(t.hash[a:b], t.size[a:b], t.start[a:b] - end[a], t.tri[end[a] : end[b]], t.at[i : j + 1] - a)
        i = j


def text_features(t: Sample, net: Network) -> np.ndarray:
    """For each text 1, largest window logit, log(1 + expected number of toxic windows); not finite without windows."""
    w = net.weights
    out = np.full((len(t.at) - 1, 3), -np.inf)
    text, first, length = windows(t.at)
    if not len(text):
        return out
    table = w["word"] @ w["wx"] + w["bx"]
    chars = np.add.reduceat(w["char"][t.tri], t.start, axis=0) / t.size[:, None].astype(np.float32)
    ids = _word_ids(net.words, t.hash)
    logits = np.empty(len(text))
    full = np.flatnonzero(length == WINDOW)
    for group, masked in ((full, False), (np.flatnonzero(length < WINDOW), True)):
        group = group[np.argsort(length[group], kind="stable")]
        for i in range(0, len(group), PARTS):
            b = group[i : i + PARTS]
            time = int(length[b].max())
            cell = first[b] + np.minimum(np.arange(time)[:, None], length[b] - 1)
            mask = (np.arange(time)[:, None] < length[b]).astype(np.float32)[:, :, None] if masked else None
            x = table[ids[cell]] + (chars[cell].reshape(-1, CHAR_DIM) @ w["cx"]).reshape(*cell.shape, -1)
            logits[b] = _forward(w, x, mask)
    new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    top = np.maximum.reduceat(logits, new)
    total = np.add.reduceat(_sigmoid(logits), new)
    out[text[new]] = np.stack([np.ones(len(new)), top, np.log1p(total)], 1)
    return out


def scores(features: np.ndarray, net: Network) -> np.ndarray:
    has = np.isfinite(features[:, 1])
    return np.where(has, _sigmoid(np.where(has[:, None], features, 0) @ net.final), net.base)


def _scored(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch_scores(batch.column(1), net))], ["id", "score"])

    return run


def batch_scores(texts: pa.Array, net: Network | None) -> np.ndarray:
    """Score of every text of an Arrow column, in parts of about a megabyte; a null text counts as empty."""
    if net is None or not len(texts):
        return np.zeros(len(texts))
    out = []
    for t, _, _ in chunks(pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], ["id", "text"]), lower=True, limit=1 << 20, spaces=SEPARATORS):
        out.append(scores(text_features(compact(t), net), net))
    return np.concatenate(out)


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = FIT_TEXTS, limit_bytes: int = FIT_BYTES) -> Network | None:
    """Fit on labelled texts that are not held out: by a hash of the id those of the first limit texts that fit into limit_bytes of text.

    An id with several labels counts with the largest, one with several texts with the smallest.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(limit).select("id", "label", F.xxhash64("id").alias("turn"))
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    sizes = docs.select("id", F.octet_length("text").alias("bytes")).join(F.broadcast(known), "id").groupBy("id").agg(F.max("bytes").alias("bytes"), F.first("turn").alias("turn")).collect()
    sizes.sort(key=lambda r: (r["turn"], r["id"]))
    chosen, room = [], limit_bytes
    for r in sizes:  # a text that does not fit is left out, and those behind it go on
        if r["bytes"] <= room:
            chosen.append((r["id"],))
            room -= r["bytes"]
    if not chosen:
        return None
    wanted = documents.sparkSession.createDataFrame(chosen, known.select("id").schema)
    rows = docs.join(F.broadcast(known.join(F.broadcast(wanted), "id")), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).collect()
    rows = sorted(rows, key=lambda r: r["id"])
    return fit([r["text"] for r in rows], np.array([r["label"] for r in rows], np.int64))


def score(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, net: Network | None = None) -> DataFrame:
    """Rows (id_col, held_out, score, predicted) for every text."""
    net = net or learn(documents, labels, id_col=id_col, text_col=text_col)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_scored(net), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The input's rows (all columns) whose own score is below the threshold, whatever their id; one pass without a shuffle.

    Only texts go to Python and only scores come back; the rows wait where they are.
    """
    net = learn(documents, labels, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(batch_scores(texts, net))

    return documents.where(F.arrow_udf(run, "double")(F.col(text_col).cast("string")) < threshold)
