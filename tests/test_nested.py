from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartweave.operators.nested import (
    explode_flatten_all,
    extract_ids,
    first_array_line,
    flatten_struct,
    pair_coordinates,
    split_child_tables,
    unnest,
    unnest_cross,
    unnest_zip,
)
from conftest import rows

ARRAYS = "id INT, a ARRAY<INT>, b ARRAY<STRING>"


def test_unnest_inner_and_outer(spark):
    df = spark.createDataFrame([(1, [1, 2], None), (2, [], None), (3, None, None)], ARRAYS)
    assert rows(unnest(df, "x", "a"), "id", "x") == [(1, 1), (1, 2)]
    assert rows(unnest(df, "x", "a", outer=True), "id", "x") == [(1, 1), (1, 2), (2, None), (3, None)]


def test_cross_and_zip(spark):
    df = spark.createDataFrame([(1, [1, 2], ["p", "q", "r"]), (2, [3], [])], ARRAYS)
    cross = unnest_cross(df, {"x": "a", "y": "b"})
    assert rows(cross, "id", "x", "y") == [(1, i, t) for i in (1, 2) for t in "pqr"]
    assert rows(unnest_zip(df, ["a", "b"])) == [(1, 1, "p"), (1, 2, "q"), (1, None, "r"), (2, 3, None)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), max_size=4), st.lists(st.text("xyz", max_size=2), max_size=3)), min_size=1, max_size=4))
def test_flatten_all_multiplies_array_sizes(spark, data):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(data)], ARRAYS)
    want = sum(max(len(a), 1) * max(len(b), 1) for a, b in data)
    assert explode_flatten_all(df).count() == want


def test_flatten_all_names(spark):
    df = spark.createDataFrame([(1, [((2,), [(3,)])])], "id INT, s ARRAY<STRUCT<p: STRUCT<q: INT>, r: ARRAY<STRUCT<t: INT>>>>")
    flat = explode_flatten_all(df)
    assert flat.columns == ["id", "s.p.q", "s.r.t"]
    assert rows(flat, "id", "`s.p.q`", "`s.r.t`") == [(1, 2, 3)]
    assert flatten_struct(spark.createDataFrame([((1, 2),)], "s STRUCT<a: INT, b: INT>")).columns == ["s_a", "s_b"]


def test_child_tables(spark):
    df = spark.createDataFrame([("p", [(1, "x")], ["l"]), ("q", None, [])], "id STRING, c ARRAY<STRUCT<n: INT, t: STRING>>, l ARRAY<STRING>")
    tables = split_child_tables(df, "Thing")
    assert sorted(tables) == ["Thing", "Thing.c", "Thing.l"]
    assert rows(tables["Thing"]) == [("p",), ("q",)]
    assert rows(tables["Thing.c"], "Thing_id", "n", "t") == [("p", 1, "x")]
    assert rows(tables["Thing.l"], "Thing_id", "l") == [("p", "l")]


def test_extract_ids_and_first_line(spark):
    df = spark.createDataFrame([("urn:uuid:1", ["a", "b"]), (None, [])], "ref STRING, line ARRAY<STRING>").withColumnRenamed("ref", "subject.reference")
    assert rows(first_array_line(extract_ids(df, "subject.reference"), "line"), "subject_id", "line") == [("1", "a"), (None, None)]


def test_coordinates_pair_within_the_address(spark):
    ddl = "home STRUCT<extension: ARRAY<STRUCT<url: STRING, extension: ARRAY<STRUCT<url: STRING, valueDecimal: DOUBLE>>>>>"
    def place(*items):
        return (([("geo", list(items)), ("other", None)],),)
    data = [place(("latitude", 1.0), ("longitude", 2.0)), place(("latitude", 3.0)), place(), ((None,),)]
    df = spark.createDataFrame(data, ddl)
    assert rows(df.select(F.inline(pair_coordinates(F.col("home"))))) == [(1.0, 2.0)]
