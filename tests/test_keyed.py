from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chartweave.operators.keyed import latest_per_key, one_per_key, rows_without_key, upsert_merge
from conftest import rows

DDL = "k STRING, batch_id INT, name STRING, kind STRING"
TARGET = "k STRING, name STRING, kind STRING"
text = st.one_of(st.none(), st.sampled_from("abc"))


def replay(target, updates, updated):
    """Row-by-row upsert in order of batch and then values, NULLs first."""
    table = {k: {"name": n, "kind": c} for k, n, c in target}
    order = sorted(updates, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    for k, _, name, kind in order:
        if k is None:
            continue
        new = {"name": name, "kind": kind}
        if k in table:
            table[k].update({c: new[c] for c in updated})
        else:
            table[k] = new
    return sorted(((k, v["name"], v["kind"]) for k, v in table.items()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.sampled_from("stuv"), st.tuples(text, text), max_size=3),
    st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("stuvw")), st.integers(0, 3), text, text), max_size=12),
    st.sampled_from([["name", "kind"], ["name"]]),
)
def test_upsert_equals_replay(spark, target, updates, updated):
    before = [(k, n, c) for k, (n, c) in target.items()]
    merged = upsert_merge(
        spark.createDataFrame(before, TARGET), spark.createDataFrame(updates, DDL), ["k"], ["batch_id"], updated
    )
    assert rows(merged) == replay(before, updates, updated)


def test_nulls_overwrite(spark):
    data = spark.createDataFrame([("s", 0, "a", "x"), ("s", 1, None, "y")], DDL)
    assert rows(latest_per_key(data, ["k"], ["batch_id"])) == [("s", None, "y")]
    assert rows(latest_per_key(data, ["k"], ["batch_id"], ("kind",))) == [("s", None, "x")]


def test_repeats_give_the_same_rows(spark):
    data = spark.createDataFrame([("s", 0, "a", "x"), ("s", 1, "b", "y"), ("t", 0, None, None)] * 5, DDL)
    plain = latest_per_key(data, ["k"], ["batch_id"], ("kind",))
    assert rows(latest_per_key(data, ["k"], ["batch_id"], ("kind",), repeats=True)) == rows(plain)


def test_rows_without_key_are_reported(spark):
    data = spark.createDataFrame([(None, 0, "a", "x"), ("s", 0, "b", "y")], DDL)
    assert rows(rows_without_key(data, "k"), "name") == [("a",)]
    assert rows(latest_per_key(data, ["k"], ["batch_id"]), "k") == [("s",)]


def test_one_per_key_takes_the_smallest_row(spark):
    data = spark.createDataFrame([("s", "b", "x"), ("s", "a", "z"), (None, "c", "q"), (None, None, "r")], TARGET)
    assert rows(one_per_key(data, "k")) == [("s", "a", "z"), (None, None, "r")]
