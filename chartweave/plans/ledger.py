"""Batch ledger: which batch has passed which layer, and who works on it.

The functions over DataFrames hold the rules; :class:`Ledger` keeps one small table per layer, of which every row is a
file of its own. A batch is recorded only after its data is written, so a lost job is simply run again.

Several jobs may run at once. Every row, and whatever jobs must not share, is a file that only one of them can create
(:mod:`claims`): a new batch with its folders, the work on a batch in a layer, and the number of a load. (Appends to
one folder by several Spark jobs would not do: the first to commit removes what the others are writing.) A job that
fails gives its batch back; one that was lost with its driver keeps it until the lease is over, or until a job is told
to resume.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER_DDL
from .claims import make_folder, names, publish

LAYERS = ("bronze", "silver", "gold", "export")
FOLDERS_DDL = "batch_id INT, source STRING, outer ARRAY<STRING>"
#: hours after which a batch is taken from a job that neither finished nor failed
LEASE_HOURS = 24.0
REJECTS_DDL = "batch_id INT, source STRING, n_rejected BIGINT"
FIRST_BATCH = 0


def of_source(ledger: DataFrame, source: str) -> DataFrame:
    return ledger.where(F.col("source") == source)


def last_batch(ledger: DataFrame, source: str) -> DataFrame:
    """One row: the highest batch id of the source, NULL when it has none."""
    return of_source(ledger, source).agg(F.max("batch_id").alias("batch_id"))


def next_batch(ledger: DataFrame, source: str) -> DataFrame:
    return last_batch(ledger, source).select(F.coalesce(F.col("batch_id") + 1, F.lit(FIRST_BATCH)).alias("batch_id"))


def pending_batches(done: DataFrame, taken: DataFrame, source: str, match_source: bool = True) -> DataFrame:
    """Batches of the source that the layer before has finished and this layer has not.

    ``match_source=False`` compares batch ids alone on the taken side.
    """
    ready = of_source(done, source).groupBy("batch_id").agg(F.min("save_ts").alias("save_ts"))
    seen = of_source(taken, source) if match_source else taken
    return ready.join(seen.select("batch_id").distinct(), "batch_id", "left_anti")


def oldest(pending: DataFrame) -> DataFrame:
    """The batch that has waited longest; equal times go by batch id."""
    return pending.orderBy("save_ts", "batch_id").limit(1)


class Ledger:
    def __init__(self, spark: SparkSession, root: str, lease_hours: float = LEASE_HOURS):
        """``lease_hours=0`` resumes: every batch that is not recorded is free."""
        self.spark = spark
        self.root = root
        self.lease = lease_hours * 3600

    def path(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.root}/ledger/{layer}"

    def _rows(self, folder: str, ddl: str) -> DataFrame:
        make_folder(self.spark, folder)
        return self.spark.read.schema(ddl).json(folder)

    # --- folders of batches
    def _planned(self, source: str) -> str:
        return f"{self.root}/ledger/planned/{quote(source, safe='')}"

    def folders(self, source: str) -> DataFrame:
        """``(batch_id, source, outer)``: the folders that batches of the source have taken."""
        rows = self._rows(self._planned(source), FOLDERS_DDL)
        return rows.select("batch_id", "source", F.explode("outer").alias("outer"))

    def take_folders(self, batch_id: int, source: str, outer: list[str]) -> bool:
        """Plan a batch, unless another job has planned one with this id. Written before anything is loaded, so a
        batch that is run again loads the same folders."""
        plan = json.dumps({"batch_id": batch_id, "source": source, "outer": outer})
        return publish(self.spark, f"{self._planned(source)}/{batch_id}", plan)

    def claim_folders(self, source: str, choose: Callable[[DataFrame], list[str]]) -> tuple[int, list[str]] | None:
        """The oldest free batch that was planned but not loaded, or else a new one of the folders that ``choose``
        picks beside those taken; None when it picks none."""
        while True:
            taken = self.folders(source)
            planned = sorted(map(int, names(self.spark, self._planned(source))))
            recorded = {row["batch_id"] for row in of_source(self.read("bronze"), source).select("batch_id").collect()}
            for batch_id in planned:
                if batch_id not in recorded and self.claim("bronze", batch_id, source):
                    outer = taken.where(taken.batch_id == batch_id).select("outer").collect()
                    return batch_id, [row["outer"] for row in outer]
            outer = choose(taken)
            if not outer:
                return None
            batch_id = max([FIRST_BATCH - 1, *planned, *recorded]) + 1
            if self.take_folders(batch_id, source, outer) and self.claim("bronze", batch_id, source):
                return batch_id, outer

    # --- work on a batch
    def _attempts(self, layer: str, batch_id: int, source: str) -> str:
        return f"{self.root}/ledger/claims/{layer}/{quote(source, safe='')}/{batch_id}"

    def claim(self, layer: str, batch_id: int, source: str) -> bool:
        """Take the work on a batch, if it is neither done nor in another job's hands."""
        folder = self._attempts(layer, batch_id, source)
        found = names(self.spark, folder)
        attempts = [int(name) for name in found if name.isdigit()]
        last = max(attempts, default=-1)
        if attempts and f"{last}.released" not in found and found[str(last)] < self.lease:
            return False
        if not publish(self.spark, f"{folder}/{last + 1}", self.spark.sparkContext.applicationId):
            return False
        return of_source(self.read(layer), source).where(F.col("batch_id") == batch_id).isEmpty()

    def release(self, layer: str, batch_id: int, source: str) -> None:
        folder = self._attempts(layer, batch_id, source)
        last = max((int(name) for name in names(self.spark, folder) if name.isdigit()), default=None)
        if last is not None:
            publish(self.spark, f"{folder}/{last}.released")

    @contextmanager
    def working(self, layer: str, batch_id: int, source: str) -> Iterator[None]:
        """Record the claimed batch at the end; a failure gives it back."""
        try:
            yield
            self.record(layer, batch_id, source)
        except BaseException:
            self.release(layer, batch_id, source)
            raise

    def claim_pending(self, layer: str, source: str) -> int | None:
        """The oldest batch that the layer before has finished and that no job works on."""
        before = LAYERS[LAYERS.index(layer) - 1]
        pending = pending_batches(self.read(before), self.read(layer), source).orderBy("save_ts", "batch_id")
        for row in pending.toLocalIterator():
            if self.claim(layer, row["batch_id"], source):
                return row["batch_id"]
        return None

    def _parts(self, layer: str, batch_id: int, source: str) -> str:
        return f"{self.root}/ledger/parts/{layer}/{quote(source, safe='')}/{batch_id}"

    def parts(self, layer: str, batch_id: int, source: str) -> set[str]:
        """Names of the batch's tables that an unfinished job has completed."""
        return set(names(self.spark, self._parts(layer, batch_id, source)))

    def record_part(self, layer: str, batch_id: int, source: str, name: str) -> None:
        publish(self.spark, f"{self._parts(layer, batch_id, source)}/{name}")

    # --- rejects
    def rejects(self, source: str) -> DataFrame:
        """``(batch_id, source, n_rejected)`` of the batches that left bundles out."""
        return of_source(self._rows(f"{self.root}/ledger/rejects", REJECTS_DDL), source)

    def record_rejects(self, batch_id: int, source: str, n: int) -> None:
        if n:
            self._add("rejects", {"batch_id": batch_id, "source": source, "n_rejected": n})

    def _add(self, table: str, row: dict) -> None:
        name = f"{quote(row['source'], safe='')}-{row['batch_id']}.json"
        publish(self.spark, f"{self.root}/ledger/{table}/{name}", json.dumps(row))

    # --- loads of the star tables
    def next_load(self) -> int:
        """A new sequence number for a load of the star tables; no other load of any source gets it."""
        return self._claim_number("")

    def _claim_number(self, owner: str) -> int:
        taken = f"{self.root}/ledger/loads/taken"
        number = max([self.read("gold").count(), *map(int, names(self.spark, taken))]) + 1
        while not publish(self.spark, f"{taken}/{number}", owner):
            number += 1
        return number

    def load_number(self, batch_id: int, source: str) -> int:
        """The sequence number of the batch's load. A batch that is loaded again, however late, keeps its number."""
        own = f"{self.root}/ledger/loads/of/{quote(source, safe='')}/{batch_id}"
        if not names(self.spark, own):
            publish(self.spark, f"{own}/{self._claim_number(f'{source} {batch_id}')}")
        return min(map(int, names(self.spark, own)))  # of two jobs that claimed at once, both see the first

    # --- finished batches
    def create(self, layer: str) -> None:
        """Make an empty table where there is none; an existing one stays as it is."""
        make_folder(self.spark, self.path(layer))

    def read(self, layer: str) -> DataFrame:
        return self._rows(self.path(layer), LEDGER_DDL)

    def record(self, layer: str, batch_id: int, source: str) -> None:
        """Mark a batch as finished; a rerun of a recorded batch changes nothing."""
        self.path(layer)
        now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        self._add(layer, {"batch_id": batch_id, "save_ts": now, "source": source})

    def next_id(self, source: str) -> int:
        return next_batch(self.read("bronze"), source).first()["batch_id"]

    def next_pending(self, layer: str, source: str) -> int | None:
        before = LAYERS[LAYERS.index(layer) - 1]
        row = oldest(pending_batches(self.read(before), self.read(layer), source)).first()
        return row["batch_id"] if row else None
