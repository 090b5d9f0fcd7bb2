"""Helpers of the operators in this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from chartweave.session import shared_folder

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame) -> DataFrame:
    """The frame written once to the cluster's shared folder and read back.

    Cuts the lineage, survives lost executors, and makes what follows work on one fixed set of rows. The
    folder goes when the driver ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(frame.schema).parquet(path)


def released(frame: DataFrame) -> None:
    """Delete the folder of a frame that ``saved`` returned and that nothing reads any more."""
    spark = frame.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of at most ``size`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if row > start and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if len(lengths) > start:
            yield batch.slice(start)


def map_texts(frame: DataFrame, column: str, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``work`` on slices of the rows; it returns the output columns of its slice by name."""
    names = _names(frame.sparkSession, schema)

    def run(batches):
        for batch in slices(batches, column):
            out = work(batch)
            yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return frame.mapInArrow(run, schema)


def _names(spark: SparkSession, schema: str) -> list[str]:
    return StructType.fromDDL(schema).names


def _array(values):
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str) -> str:
    return _ddl(docs.schema[id_col].dataType)


def _ddl(kind: DataType) -> str:
    if not isinstance(kind, StructType):
        return kind.simpleString()
    return "struct<" + ", ".join(f"`{f.name}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"


def whole_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each row as one value ``row`` beside its text: an id for operators that hand ids through."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("text"))
