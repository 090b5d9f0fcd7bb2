from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from chartweave.schemas import RESOURCE_DDL  # noqa: E402
from chartweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def records(spark):
    """Resource dictionaries to bronze rows, through the same JSON reading as files."""
    from pyspark.sql import functions as F

    def make(*resources: dict, batch_id: int = 0):
        text = spark.createDataFrame([(json.dumps(r),) for r in resources], "value STRING")
        return text.select(
            F.lit(batch_id).alias("batch_id"), F.from_json("value", RESOURCE_DDL).alias("data")
        ).select("batch_id", F.col("data.resourceType").alias("resource_type"), "data")

    return make


def rows(df, *columns):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
