from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from chartweave.functions import (
    CONDITION_RULES,
    condition_category,
    dosage_class,
    epoch_label,
    first_of,
    multiple_birth,
    parse_date,
    parse_timestamp,
    path_tail,
    ref_to_id,
    url_tail,
)


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, want", [("urn:uuid:a-1", "a-1"), ("plain", "plain"), ("", ""), ("a:", ""), (None, None)]
)
def test_ref_to_id(spark, text, want):
    assert one(spark, text, "STRING", ref_to_id) == want


@pytest.mark.parametrize(
    "text, tail, segment", [("http://x/y/z", "z", "z"), ("http://x/y/", "", ""), ("word", "word", "word"), (None, None, None)]
)
def test_tails(spark, text, tail, segment):
    assert one(spark, text, "STRING", path_tail) == tail
    assert one(spark, text, "STRING", url_tail) == segment


def test_first_of_empty_and_missing(spark):
    assert one(spark, [], "ARRAY<STRING>", first_of) is None
    assert one(spark, None, "ARRAY<STRING>", first_of) is None
    assert one(spark, ["a", "b"], "ARRAY<STRING>", first_of) == "a"


@pytest.mark.parametrize(
    "text, want",
    [
        ("2012-03-04", datetime.date(2012, 3, 4)),
        ("2012-03-04T23:30:00-04:00", datetime.date(2012, 3, 4)),
        ("not a date", None),
        ("2012-13-40", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert one(spark, text, "STRING", parse_date) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2012-03-04T23:30:00-04:00", datetime.datetime(2012, 3, 5, 3, 30)),
        ("2012-03-04T23:30:00Z", datetime.datetime(2012, 3, 4, 23, 30)),
        ("2012-03-04T23:30:00.250+01:00", datetime.datetime(2012, 3, 4, 22, 30, 0, 250000)),
        ("2012-03-04T23:30:00", None),
        ("2012-03-04", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, want):
    assert one(spark, text, "STRING", parse_timestamp) == want


EXAMPLES = {
    "Diabetes": "Endocrine / Metabolic",
    "Essential Hypertension": "Cardiology",
    "history of cardiac arrest (situation)": "Cardiology",
    "History of amputation of foot (situation)": "Trauma / Musculoskeletal",
    "Rupture of patellar tendon": "Trauma / Musculoskeletal",
    "Overlapping malignant neoplasm of colon": "Oncology",
    "Acute bronchitis (disorder)": "Respiratory",
    "Rheumatoid arthritis": "Rheumatology",
    "Otitis media": "ENT / Allergy",
    "Alzheimer's disease (disorder)": "Neurological",
    "Child attention deficit disorder": "Mental / Behavioral",
    "Normal pregnancy": "Reproductive / Obstetrics",
    "Recurrent urinary tract infection": "Urology / Nephrology",
    "Polyp of large intestine": "Gastroenterology",
    "History of appendectomy": "Post-surgical History",
    "Drug overdose": "Toxicology",
    "Viral infection": "Other",
    "": "Other",
}


def test_categories(spark):
    data = spark.createDataFrame([*EXAMPLES.items(), (None, "Other")], "display STRING, want STRING")
    wrong = data.withColumn("got", condition_category("display")).where("got <> want").collect()
    assert wrong == []
    assert {*EXAMPLES.values()} == {*CONDITION_RULES, "Other"}


DOSE = "ARRAY<STRUCT<asNeededBoolean: BOOLEAN>>"


@pytest.mark.parametrize(
    "doses, want",
    [
        ([], "no instructions"),
        (None, "scheduled"),
        ([(True,), (False,)], "as needed"),
        ([(False,), (True,)], "scheduled"),
        ([(None,)], "scheduled"),
    ],
)
def test_dosage_class(spark, doses, want):
    assert one(spark, doses, DOSE, dosage_class) == want


def test_multiple_birth(spark):
    data = spark.createDataFrame([(True, 3), (False, None), (None, 2), (None, None)], "flag BOOLEAN, n BIGINT")
    assert [r[0] for r in data.select(multiple_birth("flag", "n")).collect()] == [1, 0, 2, None]


def test_epoch_label(spark):
    assert one(spark, 0, "BIGINT", epoch_label) == "1970-01-01 00:00:00"


def test_fractions_of_a_second(spark):
    import datetime as d

    from chartweave.functions import parse_timestamp

    texts = {
        "2020-01-01T00:00:00.1Z": 100_000, "2020-01-01T00:00:00.123456Z": 123_456, "2020-01-01T00:00:00.123456789+00:00": 123_456,
        "2020-01-01T02:00:00.050+02:00": 50_000, "2020-01-01T00:00:00Z": 0,
    }
    frame = spark.createDataFrame([(t,) for t in [*texts, "2020-01-01T00:00:00.Z", "2020-01-01T00:00:00.1234567890Z", None]], "t STRING")
    shown = {r[0]: r[1] for r in frame.select("t", (parse_timestamp("t").cast("double") * 1e6).alias("m")).collect()}
    start = d.datetime(2020, 1, 1, tzinfo=d.timezone.utc).timestamp() * 1e6
    assert all(round(shown[t] - start) == micros for t, micros in texts.items())
    assert shown["2020-01-01T00:00:00.Z"] is None and shown["2020-01-01T00:00:00.1234567890Z"] is None and shown[None] is None
