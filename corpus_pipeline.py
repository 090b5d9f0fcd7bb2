"""A training-data pipeline over ``documents``: each stage's rows are written and read again for the next.

Every stage takes and returns whole rows, so columns it doesn't know travel along, repeated rows are judged one
by one, nulls follow the rules of the operators, and an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartweave.llm.common import saved, table, whole_rows
from chartweave.llm.decontaminate import match_items
from chartweave.llm.minhash import near_duplicates
from chartweave.llm.mixing_query import mixed
from chartweave.llm.queries import TOXIC_FROM
from chartweave.llm.secrets import find_secrets
from chartweave.llm.toxicity import held_out, learn_lexicon, score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the limit; null and empty texts score as texts without terms."""
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = score_toxicity(whole_rows(docs), lexicon, id_col="row")
    return scored.where(F.col("score") < TOXIC_FROM).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates (five-word shingles, similarity 0.8).

    Of several rows with one id the first in the order of their values stays; rows without an id all stay.
    """
    found = near_duplicates(docs)
    kept = found.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    order = [F.col(f"row.`{c}`") for c in docs.columns]
    rows = whole_rows(docs).select("row", F.col("row.doc_id").alias("doc_id")).join(kept, "doc_id", "left_semi")
    once = rows.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
    return once.where("place = 1").select("row.*").union(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in windows of benchmark items."""
    found = match_items(whole_rows(docs), table(spark, sf_dir, "benchmark"), id_col="row")
    return found.where(~F.col("contaminated")).select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind; their lengths follow."""
    found = find_secrets(whole_rows(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), id_col="row")
    changed = F.col("spans") != ""
    values = {c: F.col(f"row.`{c}`") for c in docs.columns}
    values["text"] = F.col("redacted")
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.length("redacted").cast(kind)).otherwise(values["n_chars"])
    return found.select(*(value.alias(name) for name, value in values.items()))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic shares are raked to the targets, with each one's probability.

    The probability is the last column, ``mix_probability``, with as many ``_`` behind as make it a new name.
    """
    name, known = "mix_probability", {c.lower() for c in docs.columns}
    while name in known:
        name += "_"
    return mixed(docs, carry=True).where("sampled").select("row.*", F.col("probability").alias(name))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_to_targets),
]
#: SQL can't express the learnt lexicon, similarity components or the tokenizer; tests compare with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
