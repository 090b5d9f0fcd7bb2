"""The mixing query and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .mixing import ROUNDS, mix

# shares that a sample of half of all tokens can have: the rarest topics cannot be lifted further
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.9}
SHARE = 0.5
SEED = "mix-"
WORD = r"[^\x20\x09-\x0D]+"


def topic(text="text"):
    """What a document is about, as far as its form shows: tables, legal lines, contact data, numbers or prose."""
    value = F.col(text)
    return (
        F.when(value.contains(" | "), "table")
        .when(value.contains("icense") | value.contains("opyright"), "legal")
        .when(value.contains("@"), "contact")
        .when(value.rlike("[0-9]{3}"), "numbers")
        .when(value.isNotNull(), "prose")
    )


def dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic()}


def tokens() -> Column:
    return F.regexp_count("text", F.lit(WORD)) + 1


def mixed(docs: DataFrame, carry: bool = False) -> DataFrame:
    return mix(docs, dimensions(), tokens(), powers=POWERS, share=SHARE, seed=SEED, carry=carry)


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents")).withColumn("probability", F.round("probability", 6))


def mixing_sql(rows: str) -> str:
    """The same as SQL over ``rows``, a query that gives the columns of documents."""
    names = list(POWERS)
    steps = [
        f"""docs AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang,
  coalesce(CASE WHEN contains(text, ' | ') THEN 'table'
    WHEN contains(text, 'icense') OR contains(text, 'opyright') THEN 'legal'
    WHEN contains(text, '@') THEN 'contact'
    WHEN regexp_matches(text, '[0-9]{{3}}') THEN 'numbers'
    WHEN text IS NOT NULL THEN 'prose' END, '?') AS topic,
  coalesce(len(regexp_extract_all(text, '{WORD}')) + 1, 1)::BIGINT AS n_tokens FROM ({rows}))""",
        "cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS mass FROM docs GROUP BY ALL)",
        *(f"aim_{n} AS (SELECT {n}, pow(sum(mass), {p}) AS t FROM cells GROUP BY {n})" for n, p in POWERS.items()),
        f"step0 AS MATERIALIZED (SELECT cells.*, mass / (SELECT sum(mass) FROM cells) AS raked, "
        f"mass / ({SHARE} * (SELECT sum(mass) FROM cells)) AS bound, "
        + ", ".join(f"aim_{n}.t / (SELECT sum(t) FROM aim_{n}) AS to_{n}" for n in names)
        + " FROM cells "
        + " ".join(f"JOIN aim_{n} ON cells.{n} = aim_{n}.{n}" for n in names)
        + ")",
    ]
    at = 0
    for _ in range(ROUNDS):
        for n in names:
            steps.append(
                f"step{at + 1} AS MATERIALIZED (SELECT * REPLACE "
                f"(least(bound, raked * to_{n} / sum(raked) OVER (PARTITION BY {n})) AS raked) FROM step{at})"
            )
            at += 1
    steps.append(f"fitted AS (SELECT *, least(1.0, raked * {SHARE} * (SELECT sum(mass) FROM cells) / mass) AS p FROM step{at})")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability,
  ('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT / 4294967296.0 < p AS sampled
FROM docs JOIN fitted USING (source, lang, topic)"""
    )


OP8_SQL = mixing_sql("SELECT * FROM documents")
