"""Chat formatting: tool calls linked with their results, ordered, validated and serialised.

Calls and results are joined by their identifier (a hash join on the conversation and the id). Calls
are ordered topologically over what they depend on: a level is one more than the largest of its
dependencies; chains are followed by doubling, calls with several dependencies in rounds; calls on a cycle, or
behind one, have no level. Arguments are parsed and checked against the tool's schema, and every message
is written as canonical JSON (sorted keys, no spaces, characters as they are). No conversation is ever
gathered: a message is a row, and (level, turn, call_id) is its order within the conversation.

Defined results: a null conversation or id links with nothing and keeps its row; a null or malformed
arguments text is invalid with the error `json`, and so is one with NaN, infinite numbers, unpaired surrogates or nesting
beyond the parser's depth; a schema property without a type takes any; an unknown tool has the error `tool`. Calls that repeat an id in a
conversation: the first by (turn, name, arguments) stands, the others are counted in n_repeats. Of
several results for one id the first by (turn, content) is linked. All other results - without a call, with a
null conversation or id, or behind the linked one - are rows of kind `result`, one each. Dependencies on ids that the conversation lacks are counted, not waited for. Empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import durable, release, together

Schema = Mapping[str, Mapping[str, Any]]
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def canonical(value: Any) -> str:
    """Canonical JSON."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def faults(arguments: Any, schema: Mapping[str, Any]) -> list[str]:
    """What is wrong with arguments: of the schema's keys required, properties (type, minimum, maximum, enum), closed."""
    if not isinstance(arguments, dict):
        return ["type"]
    fields = schema.get("properties", {})
    out = [f"missing:{k}" for k in schema.get("required", ()) if k not in arguments]
    if schema.get("closed"):
        out += [f"unknown:{k}" for k in arguments if k not in fields]
    for k, rule in fields.items():
        if k not in arguments:
            continue
        v, kind = arguments[k], rule.get("type")
        number = isinstance(v, (int, float)) and not isinstance(v, bool)
        if kind and (not isinstance(v, KINDS[kind]) or isinstance(v, bool) and kind != "boolean"):
            out.append(f"type:{k}")
        elif number and ("minimum" in rule and v < rule["minimum"] or "maximum" in rule and v > rule["maximum"]):
            out.append(f"range:{k}")
        elif "enum" in rule and v not in rule["enum"]:
            out.append(f"enum:{k}")
    return sorted(out)


def _chains(calls: DataFrame, real: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Durable tables of the calls by their number n of dependencies (conv, call_id, n), and of those with exactly one: (conv,
    call_id, anchor, dist), anchor being the first call up the chain that has none or several, null behind a cycle.

    Every chain is halved in each round, so a conversation of m dependent calls takes log2(m) rounds.
    """
    counts = real.groupBy("conv", "call_id").agg(F.count("*").alias("n"), F.min("dep").alias("dep"))
    nodes = durable(calls.select("conv", "call_id").join(counts, ["conv", "call_id"], "left").fillna(0, ["n"]), "nodes")
    target = nodes.select("conv", F.col("call_id").alias("dep"), (F.col("n") != 1).alias("final"))
    singles = nodes.where("n = 1").select("conv", "call_id", "dep").join(target, ["conv", "dep"])
    singles = durable(singles.select("conv", "call_id", F.col("dep").alias("anchor"), F.lit(1).cast("long").alias("dist"), "final"), "chains")
    most = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach < most and not singles.where("not final").isEmpty():
        ahead = singles.select("conv", F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("dist").alias("more"), F.col("final").alias("last"))
        met = singles.where("not final").join(ahead, ["conv", "anchor"])
        met = met.select("conv", "call_id", F.col("next").alias("anchor"), (F.col("dist") + F.col("more")).alias("dist"), F.col("last").alias("final"))
        after = durable(singles.where("final").unionAll(met.select(singles.columns)), "chains")
        release(singles)
        singles, reach = after, 2 * reach
    return nodes, singles


def levels(calls: DataFrame) -> DataFrame:
    """Rows (conv, call_id, level, n_missing) of distinct calls with depends_on: array of ids in the same conversation.

    Chains of calls with one dependency are followed by doubling; only calls with several are levelled
    round by round, as many rounds as such calls lie behind each other.
    """
    edges = calls.select("conv", "call_id", F.explode("depends_on").alias("dep")).distinct()
    known = calls.select("conv", F.col("call_id").alias("dep"))
    real = durable(edges.join(known, ["conv", "dep"], "left_semi"), "edges")
    missing = edges.join(known, ["conv", "dep"], "left_anti").groupBy("conv", "call_id").agg(F.count("*").alias("n_missing"))
    nodes, singles = _chains(calls, real)
    tips = singles.where("final").select("conv", "call_id", "anchor", "dist")
    done = [durable(nodes.where("n = 0").select("conv", F.col("call_id").alias("anchor"), F.lit(0).cast("long").alias("base")), "levels")]
    # of each call with several dependencies, the anchors of these; an anchor behind a cycle never gets a level
    forks = real.join(nodes.where("n > 1").select("conv", "call_id"), ["conv", "call_id"], "left_semi")
    forks = forks.join(singles.select("conv", F.col("call_id").alias("dep"), F.when(F.col("final"), F.col("anchor")).alias("anchor"), "dist", F.lit(True).alias("single")), ["conv", "dep"], "left")
    open_forks = durable(forks.select("conv", "call_id", F.when(F.col("single"), F.col("anchor")).otherwise(F.col("dep")).alias("anchor"), F.coalesce("dist", F.lit(0).cast("long")).alias("dist")), "forks")
    while not open_forks.isEmpty():
        met = open_forks.join(together(done), ["conv", "anchor"], "left")
        ready = met.groupBy("conv", "call_id").agg(F.count_if(F.col("base").isNull()).alias("open"), F.max(F.col("base") + F.col("dist") + 1).alias("base"))
        ready = durable(ready.where("open = 0").select("conv", F.col("call_id").alias("anchor"), "base"), "levels")
        done.append(ready)
        if ready.isEmpty():
            break
        left = durable(open_forks.join(ready.select("conv", F.col("anchor").alias("call_id")), ["conv", "call_id"], "left_anti"), "forks")
        release(open_forks)
        open_forks = left
    release(open_forks)
    own = nodes.where("n <> 1").select("conv", "call_id", F.col("call_id").alias("anchor"), F.lit(0).cast("long").alias("dist"))
    found = own.unionAll(tips).join(together(done), ["conv", "anchor"]).select("conv", "call_id", (F.col("base") + F.col("dist")).cast("int").alias("level"))
    return calls.select("conv", "call_id").join(found, ["conv", "call_id"], "left").join(missing, ["conv", "call_id"], "left").fillna(0, ["n_missing"])


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError("not a JSON number")
    return value


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def parsed(text: str | None) -> Any:
    """The value of a JSON text. ValueError where it is none, nests too deeply, or holds numbers or characters that JSON in UTF-8 cannot carry."""
    if text is None:
        raise ValueError("null")
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_no_constant)
        canonical(value).encode()
    except RecursionError as e:
        raise ValueError("too deep") from e
    return value


def _written(schemas: Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == "result":
                    message = {"content": row["content"], "role": "tool", "tool_call_id": row["call_id"]}
                    out.append((None, None, canonical(message)))
                    continue
                try:
                    arguments = parsed(row["arguments"])
                except ValueError:
                    arguments, wrong = row["arguments"], ["json"]
                else:
                    wrong = faults(arguments, schemas[row["name"]]) if row["name"] in schemas else ["tool"]
                message = {"arguments": arguments, "id": row["call_id"], "level": row["level"], "name": row["name"], "role": "assistant"}
                if row["linked"]:
                    message["result"] = row["content"]
                out.append((not wrong, ",".join(wrong), canonical(message)))
            valid, errors, text = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [])
            names = ["conv", "call_id", "kind", "turn", "name", "level", "linked", "n_missing", "n_repeats"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(text, pa.string())], [*names, "valid", "errors", "message"])

    return run


def format_calls(calls: DataFrame, results: DataFrame, schemas: Schema) -> DataFrame:
    """Rows (conv, call_id, kind, turn, name, level, linked, n_missing, n_repeats, valid, errors, message).

    calls: conv, call_id, turn, name, arguments (JSON text), depends_on (array of ids). results: conv, call_id, turn, content.
    """
    first = F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("x")
    whole = calls.where("conv is not null and call_id is not null")
    distinct = whole.groupBy("conv", "call_id").agg(first, (F.count("*") - 1).alias("n_repeats")).select("conv", "call_id", "x.*", "n_repeats")
    distinct = durable(distinct, "calls")
    # equal results are counted, not dropped: every result is either linked or a row of its own
    named = results.where("conv is not null and call_id is not null").groupBy("conv", "call_id", "turn", "content").agg(F.count("*").alias("n"))
    answers = named.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    linked = distinct.hint("shuffle_hash").join(answers, ["conv", "call_id"], "left").join(levels(distinct), ["conv", "call_id"])
    rows = linked.select("conv", "call_id", F.lit("call").alias("kind"), "turn", "name", "arguments", "level", F.col("r").isNotNull().alias("linked"), "r.content", F.col("n_missing").cast("long").alias("n_missing"), "n_repeats")
    nothing = {"level": "int", "n_missing": "long", "n_repeats": "long"}
    loose = calls.where("conv is null or call_id is null").select("conv", "call_id", F.lit("call").alias("kind"), "turn", "name", "arguments", F.lit(False).alias("linked"), F.lit(None).cast("string").alias("content"), *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    taken = distinct.select("conv", "call_id").join(answers, ["conv", "call_id"])
    others = named.join(taken, ["conv", "call_id"], "left").withColumn("n", F.col("n") - F.coalesce(F.col("r.turn").eqNullSafe(F.col("turn")) & F.col("r.content").eqNullSafe(F.col("content")) & F.col("r").isNotNull(), F.lit(False)).cast("int"))
    others = others.select("conv", "call_id", "turn", "content", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).drop("col")
    others = others.unionByName(results.where("conv is null or call_id is null").select("conv", "call_id", "turn", "content"))
    orphans = others.select("conv", "call_id", F.lit("result").alias("kind"), "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.lit(False).alias("linked"), "content", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    rows = rows.unionByName(loose).unionByName(orphans)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "call_id", "turn")}
    return rows.mapInArrow(_written(schemas), f"conv {kinds['conv']}, call_id {kinds['call_id']}, kind string, turn {kinds['turn']}, name string, level int, linked boolean, n_missing long, n_repeats long, valid boolean, errors string, message string")


def digests(messages: DataFrame) -> DataFrame:
    """Messages with the SHA-256 of their text in its place."""
    return messages.withColumn("message_sha256", F.sha2("message", 256)).drop("message")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
