"""The url query and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .url_rules import LOWER, UPPER, judge_urls

# Host, path and verdict of the rules.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT = "allow"


def op11_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host STRING, path STRING, verdict STRING")
    return judge_urls(table(spark, folder, "pages"), rules, default=DEFAULT)


def _matches() -> str:
    """The rules from longest to shortest; no two of them fit one url and have the same length."""
    order = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    return " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{place}}}"
        for place, (h, p, _) in enumerate(order)
    ).format(*(f"'{h}{p}|{v}'" for h, p, v in order))


OP11_SQL = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS (SELECT *, CASE {_matches()} END AS found FROM parts)
SELECT page_id, host, path, split_part(found, '|', 1) AS rule, coalesce(split_part(found, '|', 2), '{DEFAULT}') AS verdict
FROM judged"""
