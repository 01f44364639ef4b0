"""Duplicates across arrivals and restarts, and state that expires."""

import time

import pytest

from cartoscope import streaming


@pytest.fixture
def folders(tmp_path):
    return [f"{tmp_path}/{n}" for n in ("in", "out", "mark")]


def arrive(spark, folders, rows, keep_ms=10**9):
    src, out, mark = folders
    spark.createDataFrame(rows, "name string, text string").write.mode("append").parquet(src)
    found = streaming.report_duplicates(spark, src, "name string, text string", "text", "name", out, mark, keep_ms)
    return {r.file: (r.first, r.duplicate_of) for r in found.collect()}


def test_duplicates_across_arrivals(spark, folders):
    one = arrive(spark, folders, [("a", "x"), ("b", "y"), ("c", "x"), ("n", None)])
    firsts = [f for f in "ac" if one[f][0]]
    assert len(firsts) == 1 and one["b"] == (True, None) and one["n"] == (True, None)
    assert one["c" if firsts == ["a"] else "a"] == (False, firsts[0])
    two = arrive(spark, folders, [("d", "y"), ("e", "z"), ("f", "y")])
    assert {k: two[k] for k in one} == one  # reported once
    assert (two["d"], two["e"], two["f"]) == ((False, "b"), (True, None), (False, "b"))


def test_state_expires(spark, folders):
    assert arrive(spark, folders, [("a", "x")], 1500) == {"a": (True, None)}
    time.sleep(3)
    assert arrive(spark, folders, [("b", "x")], 1500)["b"] == (True, None)


def test_equal_names_and_many_contents(spark, folders):
    rows = [("a", "x"), ("a", "x"), (None, "w"), (None, "w"), ("z", "v"), (None, "v")]
    src, out, mark = folders
    spark.createDataFrame(rows, "name string, text string").write.parquet(src)
    found = [tuple(r)[1:] for r in streaming.report_duplicates(spark, src, "name string, text string", "text", "name", out, mark).collect()]
    assert sorted(found, key=str) == sorted([("a", True, None), ("a", False, "a"), (None, True, None), (None, False, None), ("z", True, None), (None, False, "z")], key=str)
    assert streaming.report_duplicates(spark, src, "name string, text string", "text", "name", out, mark).count() == 6  # nothing arrived


def test_smallest_name_is_first_whatever_the_order(spark, folders):
    src, out, mark = folders
    for part in range(3):
        rows = spark.range(part * 1000, part * 1000 + 2000, 1, 8).selectExpr("printf('%04d', 9999 - id) AS name", "cast(id % 250 as string) AS text")
        rows.write.mode("append").parquet(src)
        found = streaming.report_duplicates(spark, src, "name string, text string", "text", "name", out, mark)
    assert found.where("first").count() == 250 and found.count() == 6000
    firsts = {r.file for r in found.where("first").collect()}
    assert firsts == {f"{9999 - k:04d}" for k in range(1750, 2000)}  # of the first arrival, the smallest name of each content
    assert {r.duplicate_of for r in found.where("not first").collect()} == firsts
