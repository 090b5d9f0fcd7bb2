"""Mixing against its SQL, and the pipeline stage by stage against plain versions."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chartweave.llm import mixing_query, queries
from chartweave.llm.mixing import fit, margins, mix, rake, weighted
from chartweave.llm.mixing_query import OP8_SQL, mixing_sql
from chartweave.llm.secrets import KINDS
from tools.check_oracles import compare

from . import brute

DATA = "/root/testdata/sf0.001"
DDL = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, id STRING, row INT, score DOUBLE"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = corpus_pipeline.saved(stage(spark, docs, DATA))
    return [*out, docs]


def _pairs(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_order_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert all(f.columns == stages[0].columns and f.dtypes == stages[0].dtypes for f in stages[:-1])


def test_toxicity_stage(spark, stages):
    scores = {r.doc_id: r.predicted for r in queries.op9_toxicity(spark, DATA).collect()}
    kept = {i for i, _ in _pairs(stages[1])}
    assert kept == {i for i, p in scores.items() if not p} and 0 < len(kept) < len(scores)


def test_near_duplicate_stage(stages):
    want = [i for i, _, comp, kept in brute.near_components(_pairs(stages[1]), 5, 80) if kept]
    assert sorted(i for i, _ in _pairs(stages[2])) == sorted(want)


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = [r[0] for r in brute.contamination(_pairs(stages[2]), items) if not r[5]]
    assert sorted(i for i, _ in _pairs(stages[3])) == sorted(want)


def test_secret_stage(stages):
    before = dict(_pairs(stages[3]))
    after = {r.doc_id: r for r in stages[4].collect()}
    assert set(before) == set(after)
    for i, text in before.items():
        assert not brute.base_spans(after[i].text)
        assert after[i].n_chars == len(after[i].text)
        if brute.base_spans(text):
            assert any(f"[{kind}]" in after[i].text for kind in KINDS)


def test_mixing_stage(stages):
    con = duckdb.connect()
    con.register("given", stages[4].toPandas())
    rows = con.sql(mixing_sql("SELECT * FROM given")).fetchall()
    want = {r[0]: r[5] for r in rows if r[6]}
    got = {r.doc_id: round(r.mix_probability, 6) for r in stages[5].collect()}
    assert got == pytest.approx(want, abs=2e-6)


def test_run_gives_the_same(spark, stages):
    assert sorted(corpus_pipeline.run(spark, DATA).collect()) == sorted(stages[-1].collect())


def test_stages_with_clashing_columns(spark):
    rows = [(1, "one two three four five six", "en", "s", "kept", 7.0, "p", "q"), (1, "other words are here", "en", "s", "kept", 7.0, "p", "q")]
    ddl = "doc_id LONG, text STRING, lang STRING, source STRING, `first of its id` STRING, mix_probability DOUBLE, `place` STRING, `a.b` STRING"
    docs = spark.createDataFrame(rows, ddl)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    assert once.columns == docs.columns and [tuple(r)[4:] for r in once.collect()] == [("kept", 7.0, "p", "q")]
    mixed = corpus_pipeline.mix_to_targets(spark, docs, DATA)
    assert mixed.columns == [*docs.columns, "mix_probability_"]
    assert all(r.mix_probability == 7.0 and 0 <= r.mix_probability_ <= 1 for r in mixed.collect())


def test_stages_with_odd_rows(spark):
    rows = [
        (1, None, None, None, None, "a", 1, 0.5), (2, "", "en", "s", 0, None, None, None), (3, "one two", "en", None, 7, "c", 3, 1.0),
        (3, "one two", "en", None, 7, "c", 3, 1.0), (None, "api_key=abcdefgh99", None, "s", 18, "d", 4, 0.1),
        (None, "api_key=abcdefgh99", None, "s", 18, "d", 4, 0.1), (4, "word " * 50_000, "de", "t", 250_000, "e", 5, 0.0),
    ]
    docs = spark.createDataFrame(rows, DDL)
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        found = out.collect()
        counts[name] = len(found)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert stage(spark, docs.limit(0), DATA).count() == 0
    assert counts["toxicity"] == 7 and counts["near_duplicates"] == 6 and counts["secrets"] == 7
    redacted = corpus_pipeline.redact_secrets(spark, docs, DATA).where("doc_id IS NULL").first()
    assert redacted.text == "[assign]" and redacted.n_chars == 8


@pytest.mark.parametrize("folder", [DATA, "/root/testdata/sf0.01"])
def test_mixing_query(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    outcome = compare(spark, con, "op8_mix_sources", queries.op8_mix_sources, OP8_SQL, folder)
    assert outcome.startswith("ok"), outcome


def test_raked_margins(spark):
    cells = spark.createDataFrame(
        [("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 50.0), ("b", "y", 5.0), ("c", "y", 1.0)], "s STRING, l STRING, mass DOUBLE"
    )
    aims = {
        "s": spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 1.0), ("none", 9.0)], "s STRING, target DOUBLE"),
        "l": spark.createDataFrame([("x", 0.4), ("y", 0.6)], "l STRING, target DOUBLE"),
    }
    got = rake(cells, aims, 40)
    assert {r.s: round(r.t, 4) for r in got.groupBy("s").agg(F.sum("raked").alias("t")).collect()} == {"a": 0.5, "b": 0.25, "c": 0.25}
    assert {r.l: round(r.t, 4) for r in got.groupBy("l").agg(F.sum("raked").alias("t")).collect()} == {"x": 0.4, "y": 0.6}


@pytest.mark.parametrize("folder", [DATA, "/root/testdata/sf0.01"])
def test_final_margins_meet_their_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = weighted(docs, mixing_query.dimensions(), mixing_query.tokens())
    cells, aims = fit(rows, list(mixing_query.POWERS), mixing_query.POWERS, share=mixing_query.SHARE)
    reached = margins(cells, aims).collect()
    assert {r.dimension for r in reached} == {"source", "lang", "topic"}
    assert max(abs(r.reached - r.target) for r in reached) < 0.002
    r = cells.agg(F.sum("mass").alias("all"), F.sum(F.col("mass") * F.col("probability")).alias("some")).first()
    assert abs(r.some / r["all"] - mixing_query.SHARE) < 0.002


def test_bounds_hold_where_targets_ask_for_too_much(spark):
    """The rare value is taken whole; the rest keeps to the other margin's target."""
    masses = [("rare", "x", 10), ("rare", "y", 10), ("much", "x", 600), ("much", "y", 380)]
    rows = spark.createDataFrame(masses, "s STRING, l STRING, n_tokens LONG")
    aims = {
        "s": spark.createDataFrame([("rare", 0.5), ("much", 0.5)], "s STRING, target DOUBLE"),
        "l": spark.createDataFrame([("x", 0.3), ("y", 0.7)], "l STRING, target DOUBLE"),
    }
    cells, _ = fit(rows, ["s", "l"], targets=aims, share=0.4, rounds=60)
    found = {(r.s, r.l): r.probability for r in cells.collect()}
    assert max(found.values()) <= 1 and found["rare", "y"] == 1 and found["rare", "x"] == pytest.approx(1, abs=0.01)
    reached = {(r.dimension, r.value): r.reached for r in margins(cells, aims).collect()}
    assert reached["s", "rare"] < 0.12 and found["much", "y"] > found["much", "x"]


def test_mixing_budget_and_odd_rows(spark):
    rows = [(i, "w " * (1 + i % 9), "l" + str(i % 2), None if i % 5 else "s") for i in range(4000)] + [(None, None, None, None)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id LONG, text STRING, lang STRING, source STRING")
    got = mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, F.length("text"), share=0.3)
    r = got.agg(F.sum("n_tokens").alias("all"), F.sum(F.when(F.col("sampled"), F.col("n_tokens"))).alias("some")).first()
    assert got.count() == 4002 and abs(r.some / r["all"] - 0.3) < 0.05
    assert got.where("probability > 1 OR probability < 0").count() == 0
    assert mix(docs.limit(0), {"source": F.col("source")}, F.length("text")).count() == 0
