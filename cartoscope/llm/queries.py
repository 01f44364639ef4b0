"""The queries op1 to op13 and that of all stages together, and the SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tool schemas of op1.
SCHEMAS = {
    "search": {"required": ["query"], "closed": True, "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 40}}},
    "lookup": {"required": ["key"], "closed": True, "properties": {"key": {"type": "integer", "minimum": 100}}},
    "count": {"required": ["items", "unit"], "closed": True, "properties": {"items": {"type": "array"}, "unit": {"type": "string", "enum": ["chars", "words"]}}},
}
#: The rules of op2 as keys, and the words that put a host on its block list.
ALLOW, BLOCK = ("com/", "www.example.com/en/"), ("example.com/en/", "net/es/", "net/fr/")
SPAM_WORDS = "spam|pills|casino|cheap"


def model_file() -> str:
    """The SentencePiece model; CARTOSCOPE_PIECES names another one than the installed public one."""
    if found := os.environ.get("CARTOSCOPE_PIECES"):
        return found
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model_file() -> str:
    """The byte-level BPE; CARTOSCOPE_BYTES names another one than the installed public one."""
    if found := os.environ.get("CARTOSCOPE_BYTES"):
        return found
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tool_events(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in the conversations: a user turn is a call, whose arguments follow from its text; the
    assistant turn behind it is the result; a text of even length depends on the call two turns before."""
    n = F.coalesce(F.length("text"), F.lit(0))
    name = F.element_at(F.array(*map(F.lit, ("search", "lookup", "count"))), (n % 3 + 1).cast("int"))
    search = F.to_json(F.struct("text", (n % 50).alias("limit")).withField("query", F.col("text")).dropFields("text"))
    lookup = F.to_json(F.struct(n.alias("key")))
    unit = F.when(n % 5 == 0, "pages").otherwise("chars")
    count = F.to_json(F.struct(F.array("turn", n.cast("long")).alias("items"), unit.alias("unit")))
    arguments = F.when(n % 7 == 6, F.lit("{")).when(n % 3 == 0, search).when(n % 3 == 1, lookup).otherwise(count)
    ident = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    depends = F.when(n % 2 == 0, F.array(ident(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = conversations.where("role = 'user'").select(F.col("conv_id").alias("conv"), ident(F.col("turn")).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), depends.alias("depends_on"))
    results = conversations.where("role = 'assistant'").select(F.col("conv_id").alias("conv"), ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, ordered, validated calls of all conversations, with the SHA-256 of each canonical message."""
    from cartoscope.llm.tool_calls import digests, format_calls

    return digests(format_calls(*tool_events(_table(spark, sf_dir, "conversations")), SCHEMAS)).withColumnRenamed("conv", "conv_id")


OP1_SQL = """
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, role, text, coalesce(length(text), 0) AS n FROM conversations
), calls AS (
  SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, turn, n, text,
         CASE n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'count' END AS name,
         CASE WHEN n % 2 = 0 THEN 'call-' || conv_id || '-' || (turn - 2) END AS dep
  FROM raw WHERE role = 'user'
), results AS (
  SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, turn, text AS content FROM raw WHERE role = 'assistant'
), lv AS (
  SELECT c.conv_id, c.call_id, 0 AS level FROM calls c
  WHERE dep IS NULL OR NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.dep)
  UNION ALL
  SELECT c.conv_id, c.call_id, lv.level + 1 FROM calls c JOIN lv ON c.conv_id = lv.conv_id AND c.dep = lv.call_id
), checked AS (
  SELECT c.*, lv.level,
         (dep IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.dep))::BIGINT AS n_missing,
         CASE WHEN n % 7 = 6 THEN 'json'
              WHEN name = 'search' AND n % 50 NOT BETWEEN 1 AND 40 THEN 'range:limit'
              WHEN name = 'lookup' AND n < 100 THEN 'range:key'
              WHEN name = 'count' AND n % 5 = 0 THEN 'enum:unit' ELSE '' END AS errors,
         CASE WHEN n % 7 = 6 THEN '"{"'
              WHEN name = 'search' THEN '{"limit":' || (n % 50) || ',"query":' || to_json(text)::VARCHAR || '}'
              WHEN name = 'lookup' THEN '{"key":' || n || '}'
              ELSE '{"items":[' || turn || ',' || n || '],"unit":"' || CASE WHEN n % 5 = 0 THEN 'pages' ELSE 'chars' END || '"}' END AS args
  FROM calls c JOIN lv USING (conv_id, call_id)
)
SELECT c.conv_id, c.call_id, 'call' AS kind, c.turn, c.name, c.level::INTEGER AS level, r.call_id IS NOT NULL AS linked, c.n_missing, 0::BIGINT AS n_repeats,
       c.errors = '' AS valid, c.errors,
       sha256('{"arguments":' || c.args || ',"id":"' || c.call_id || '","level":' || c.level || ',"name":"' || c.name || '"'
              || CASE WHEN r.call_id IS NOT NULL THEN ',"result":' || to_json(r.content)::VARCHAR ELSE '' END || ',"role":"assistant"}') AS message_sha256
FROM checked c LEFT JOIN results r USING (conv_id, call_id)
UNION ALL
SELECT r.conv_id, r.call_id, 'result', r.turn, NULL, NULL, false, NULL, NULL, NULL, NULL,
       sha256('{"content":' || to_json(r.content)::VARCHAR || ',"role":"tool","tool_call_id":"' || r.call_id || '"}')
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
"""


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: five rules, and a block list of hosts that have a spam word in their name."""
    from cartoscope.llm.bloom_cascade import host_and_path, judge

    pages = _table(spark, sf_dir, "pages")
    keys = lambda rules: spark.createDataFrame([(r,) for r in rules], "key string")
    host = host_and_path(F.col("url"))[0]
    listed = pages.select(host.alias("key")).where(F.col("key").rlike(SPAM_WORDS)).distinct()
    return judge(pages, keys(ALLOW), keys(BLOCK), listed, [1, 4])


OP2_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host, 'spam|pills|casino|cheap') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases in all documents."""
    from cartoscope.llm.license_scan import scan

    return scan(_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of 0.98 or more."""
    from cartoscope.llm.flat_graph import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: (x IS NULL OR NOT isfinite(x))::INT), 'sum') = 0
    AND list_aggregate(list_transform(embedding, lambda x: abs(x)::DOUBLE), 'sum') > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM reach r JOIN l ON l.a = r.node WHERE r.root < l.b
), c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id
"""


def op5_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a progressive JPEG and read back."""
    from cartoscope.llm.progressive_jpeg import read, store

    return read(store(_table(spark, sf_dir, "documents")), tensors=False)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    from cartoscope.llm.toxicity import score

    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.7)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    from cartoscope.llm.partenum import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), q=4, percent=85)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with an end id, and decoded."""
    from cartoscope.llm.pieces import encode_decode

    return encode_decode(_table(spark, sf_dir, "documents"), model_file(), end=True, digests=True)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks of documents for sources mixed to 0.95 of the largest entropy, none repeated more than four times."""
    from cartoscope.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), target_entropy=0.95, max_repeats=4.0)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 50 words that a smaller id has too."""
    from cartoscope.llm.recompression import removed_words

    return removed_words(_table(spark, sf_dir, "documents"), width=50)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of the highest score for each benchmark item."""
    from cartoscope.llm.term_scan import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of ten words of a benchmark item."""
    from cartoscope.llm.winnowing import decontaminate, digests

    return digests(decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), width=10))


#: Fixed value: what parts words, for DuckDB.
PARTS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {PARTS})"

OP11_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT *, sum(tf) OVER (PARTITION BY r)::BIGINT AS n FROM (
    SELECT r, doc_id, term, count(*) AS tf FROM (SELECT row_number() OVER () AS r, doc_id, unnest({WORDS_SQL}) AS term FROM documents) GROUP BY r, doc_id, term)
), s AS (
  SELECT count(DISTINCT r) AS docs, sum(tf)::BIGINT AS words FROM t
), w AS (
  SELECT term, floor(1000 * ln(((2 * docs + 2) / (2 * count(*) + 1))::DOUBLE))::BIGINT AS weight FROM t, s GROUP BY term, docs
), i AS (
  SELECT DISTINCT item_id, unnest({WORDS_SQL}) AS term FROM benchmark
), c AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0) WHERE rank <= 10
"""

OP12_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents
), i AS MATERIALIZED (
  SELECT item_id, {WORDS_SQL} AS w, least(len(w), 10) AS m FROM benchmark
), iw AS MATERIALIZED (
  SELECT DISTINCT item_id, m, w[p:p + m - 1] AS win FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM i WHERE len(w) > 0)
), dw AS MATERIALIZED (
  SELECT r, p, m, w[p:p + m - 1] AS win FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT m FROM iw))
), h AS MATERIALIZED (
  SELECT dw.r, dw.p, dw.m, iw.item_id FROM dw JOIN iw ON iw.m = dw.m AND iw.win = dw.win
), c AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM h) GROUP BY r
), n AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned by byte offsets, with the corpus counts of linked ids."""
    from cartoscope.llm.alignment import align

    return align(_table(spark, sf_dir, "documents"), byte_model_file(), model_file())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline, from documents to token counts."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_tool_calls, op2_url_filter, op3_license_scan, op4_embedding_dedup, op5_progressive_jpeg, op6_toxicity, op7_jaccard_join, op8_sentencepiece, op9_source_mix, op10_substring_dedup, op11_lexical_search, op12_decontamination, op13_alignment, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_tool_calls": OP1_SQL, "op2_url_filter": OP2_SQL, "op4_embedding_dedup": OP4_SQL, "op11_lexical_search": OP11_SQL, "op12_decontamination": OP12_SQL}
