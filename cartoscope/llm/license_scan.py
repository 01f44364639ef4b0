"""License scans by a positional rare-token index, in DataFrame functions only.

Templates are licence phrases with labels. The index holds, for each template, its words of the highest
inverse document frequency in the corpus with their places. A file is read once: its words at which a rare
word of some template stands give that template's start (place of the word minus place in the template);
starts on which the template's rare words agree are verified word by word against the mandatory key phrase.
Document frequencies of the template words are counted over all files first (one pass, one small row);
the index has as many rows as the templates have words, so it is part of the plan.

Everything is computed inside the file's row, so a hot source, a hot line or a long file moves no data.

Defined results: null and empty texts, and texts without words, have n_words 0, no places, empty labels and
score 0. Texts of any length are scanned whole. Rows keep their ids, null or repeated; extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Licence phrases and their labels. The first three count as base places.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
MORE = (
    ("mit license", "mit"),
    ("apache license version 2 0", "apache-2.0"),
    ("apache license", "apache"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("bsd license", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission is hereby granted free of charge", "mit"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("eclipse public license", "epl"),
)
#: Words of a template that are looked up; the others are verified.
RARE = 2


def words_of(text: Column) -> Column:
    """A-Z lower-cased words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(F.translate(text, UPPER, LOWER), F.lit("")), F.lit(WORD), F.lit(0))


def document_frequencies(files: DataFrame, words: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """In how many files each word of a fixed list occurs, over all files; and, under the empty word, the number of files."""
    found = F.array_distinct(F.filter(words_of(F.col(text_col)), lambda w: w.isin(list(words))))
    row = files.select(found.alias("w")).agg(F.count("*").alias("n"), *[F.count_if(F.array_contains("w", w)).alias(f"w{i}") for i, w in enumerate(words)]).first()
    return {"": row["n"]} | {w: row[f"w{i}"] for i, w in enumerate(words)}


def _starts(words: Column, places: Column, phrase: list[str], rare: list[int]) -> Column:
    """Starts of a phrase in a file's words: from places (word, place) of rare words, agreed and verified."""
    first, rest = rare[0], rare[1:]
    mine = F.filter(places, lambda x: x["w"] == phrase[first])
    starts = F.transform(mine, lambda x: x["p"] - first)

    def fits(s: Column) -> Column:
        ok = (s >= 0) & (s + len(phrase) <= F.size(words))
        for k in [*rest, *(k for k in range(len(phrase)) if k not in rare)]:  # relative places of the other rare words, then the key phrase
            ok = ok & (F.get(words, s + k) == phrase[k])
        return ok

    return F.filter(starts, fits)


def scan(files: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base: Sequence[tuple[str, str]] = BASE, more: Sequence[tuple[str, str]] = MORE) -> DataFrame:
    """Rows (id_col, n_words, n_base, first_word, last_word, base_labels, labels, score).

    n_base counts all places of base phrases; first_word and last_word are the smallest and largest of their starts.
    score: 1 minus the product of (1 - idf share) over the labels found, 0 without any.
    """
    rows = files.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    templates = [(p.split(), label, k < len(base)) for k, (p, label) in enumerate((*base, *more))]
    vocabulary = sorted({w for p, _, _ in templates for w in p})
    df = document_frequencies(rows, vocabulary)

    def rarity(w: str) -> float:
        return 1 - df[w] / max(1, df[""])

    index = [(p, label, is_base, sorted(range(len(p)), key=lambda k: (df[p[k]], -len(p[k]), k))[:RARE]) for p, label, is_base in templates]
    looked_up = sorted({p[rare[0]] for p, _, _, rare in index})
    out = rows.select("id", words_of(F.col("text")).alias("words"))
    marked = F.transform("words", lambda w, p: F.when(w.isin(looked_up), F.struct(w.alias("w"), p.alias("p"))))
    out = out.withColumn("places", F.filter(marked, lambda x: x.isNotNull()))
    some = F.size("places") > 0
    none = F.array().cast("array<int>")
    for k, (p, _, _, rare) in enumerate(index):
        out = out.withColumn(f"t{k}", F.when(some, _starts(F.col("words"), F.col("places"), p, rare)).otherwise(none))
    base_starts = F.concat(*[F.col(f"t{k}") for k, t in enumerate(index) if t[2]])

    def labels(chosen: list[int]) -> Column:
        each = F.array(*[F.when(F.size(f"t{k}") > 0, F.lit(index[k][1])) for k in chosen])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(each))), ",")

    missed = F.lit(1.0)
    for k, (p, _, _, rare) in enumerate(index):
        missed = missed * F.when(F.size(f"t{k}") > 0, F.lit(1 - 0.9 * rarity(p[rare[0]]))).otherwise(F.lit(1.0))
    return out.select(
        F.col("id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        F.size(base_starts).cast("long").alias("n_base"),
        F.array_min(base_starts).cast("long").alias("first_word"),
        F.array_max(base_starts).cast("long").alias("last_word"),
        labels([k for k, t in enumerate(index) if t[2]]).alias("base_labels"),
        labels(list(range(len(index)))).alias("labels"),
        F.round(1 - missed, 6).alias("score"),
    )
