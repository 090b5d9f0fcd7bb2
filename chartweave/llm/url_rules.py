"""URL rules by a sort-merge range join, in DataFrame functions alone.

A rule's canonical key is its host with the labels reversed, a byte that no text holds, and its path; the keys of
the urls under it are the interval from that key to the key followed by the same byte. A url has one key for each
tail of its host that is no longer than the longest rule's. All interval ends and url keys are sorted together and
swept in order: a start puts its rule on the stack, an end takes it off. Since the intervals of one host nest, the
top of the stack at a url's key is the longest rule there. The height of the stack is a running sum of starts less
ends, and its top the last start that reached the same height, so the sweep is two window functions. It is cut
into key ranges of about equal size, whatever host they belong to, and what is open at a range's start comes from
the few rows that sum up the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a byte that UTF-8 text never holds and that sorts after all it does hold
BEYOND = b"\xff"
# kinds of swept rows, in the order in which they come at one key
START, URL, END = 1, 0, -1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """The rule of every url: ``(id_col, host, path, rule, verdict)``.

    ``rules`` has the columns ``host``, ``path`` and ``verdict``. A rule fits its host and all its subdomains if the
    url's path starts with the rule's. Of the fitting rules the longest decides (characters of host and path, then
    of the host); ``rule`` is its host and path. A rule given with several verdicts takes the least of them, so
    ``allow`` comes before ``block``. Without a fitting rule ``rule`` is null and ``default`` is the verdict.

    A null url and one without ``://`` has an empty host and path; rules with a null host or verdict are left out
    and a null path is empty. Rows are judged one by one, so null ids and repeated rows stay; empty tables give
    empty results or urls without rules; other columns are not read. ``ranges`` is the number of key ranges, by
    default ``spark.sql.shuffle.partitions``. No range is bound to a host or url: rows of one key may lie in many.
    """
    url = F.col(f"`{url_col}`").cast("string")
    urls = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    )
    known = (
        rules.where("host IS NOT NULL AND verdict IS NOT NULL")
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
    )
    longest = known.agg(
        F.coalesce(F.max(F.size(_labels("host"))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.length("path")), F.lit(0)).alias("path"),
    ).first()
    swept = _top_of_stack(_in_ranges(_events(known), _keys(urls, longest["labels"], longest["path"]), ranges))
    best = swept.groupBy("row").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("id", "host", "path")), F.max("top").alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def _labels(host: str) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.encode(F.array_join(labels, "."), "UTF-8"), F.lit(BEYOND), F.encode(path, "UTF-8"))


def _events(rules: DataFrame) -> DataFrame:
    """Two rows per rule, where its interval begins and where it ends."""
    key = _key(_labels("host"), F.col("path"))
    ranked = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    ends = F.array(
        F.struct(key.alias("key"), F.lit(START).alias("step")),
        F.struct(F.concat(key, F.lit(BEYOND)).alias("key"), F.lit(END).alias("step")),
    )
    return rules.select(ranked.alias("rule"), F.explode(ends).alias("end")).select("end.key", "end.step", "rule")


def _keys(urls: DataFrame, labels: int, path: int) -> DataFrame:
    """A row per url and tail of its host that a rule could name; the first carries what the result needs.

    A rule sees no more of a path than its own length, so keys hold no more of it either.
    """
    tails = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(labels), F.size("labels"))))
    rows = urls.withColumn("labels", _labels("host")).select("*", F.explode(tails).alias("n"))
    once = [F.when(F.col("n") == 1, F.col(c)).alias(c) for c in ("id", "host", "path")]
    key = _key(F.slice("labels", 1, F.col("n")), F.substring("path", 1, path))
    return rows.select(key.alias("key"), F.lit(URL).alias("step"), "row", *once)


def _in_ranges(events: DataFrame, keys: DataFrame, ranges: int | None) -> DataFrame:
    """Both in key ranges numbered by ``range``; ``at`` orders rows of one key."""
    rows = events.unionByName(keys, allowMissingColumns=True)
    rows = rows.withColumn("at", F.struct("key", (-F.col("step")).alias("kind"), "row"))
    number = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so the numbers are the same in whatever reads them
    return saved(rows.repartitionByRange(number, "at").withColumn("range", F.spark_partition_id()).drop("key"))


def _top_of_stack(rows: DataFrame) -> DataFrame:
    """The url rows with the rule at the top of the stack, or null."""
    here = Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # one row per range, or per range and height
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    opened = rows.groupBy("range").agg(F.sum("step").alias("sum"))
    opened = opened.select("range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("open"))
    height = F.sum("step").over(here) + F.col("open")
    # below an end, height is that of the stack that remains
    high = saved(rows.join(opened, "range").withColumn("height", height).drop("open"))

    level = Window.partitionBy("range", "height").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    start = F.when(F.col("step") == START, F.col("rule"))
    below = Window.partitionBy("height").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = high.where("height > 0").groupBy("range", "height").agg(
        F.max_by("rule", F.when(F.col("step") == START, F.col("at"))).alias("last")
    )
    left = last.select("range", "height", F.last("last", ignorenulls=True).over(below).alias("left"))
    tops = high.join(left, ["range", "height"], "left")
    top = F.when(F.col("height") > 0, F.coalesce(F.last(start, ignorenulls=True).over(level), F.col("left")))
    return tops.withColumn("top", top).where(F.col("step") == URL).select("row", "id", "host", "path", "top")
