"""Header fields of image files of any size, read in byte ranges.

A data source for ``spark.read``: its partitions are groups of files, and a task reads of each file only the blocks
that hold the elements up to the last wanted one. Values in between are skipped by their length.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.imaging import HEADER_KIND, METADATA_DDL, TAGS, HeaderError, read_header

FILES_PER_TASK = 1000
#: bytes read at once; most headers lie in the first block
BLOCK = 4096
ROWS_PER_BATCH = 1000
DDL = f"file_path STRING, metadata {METADATA_DDL}, error STRING, bytes_read BIGINT"


class FileRanges:
    """The bytes of an open file by offset, one block in memory at a time."""

    def __init__(self, stream: pa.NativeFile):
        self._stream, self.size = stream, stream.size()
        self._start, self._block, self.bytes_read = 0, memoryview(b""), 0

    def at(self, offset: int, length: int) -> memoryview:
        """``length`` bytes, or what there is up to the end of the file."""
        if not self._start <= offset <= offset + length <= self._start + len(self._block):
            self._stream.seek(min(offset, self.size))
            self._start, self._block = offset, memoryview(self._stream.read(max(length, BLOCK)))
            self.bytes_read += len(self._block)
        place = offset - self._start
        return self._block[place : place + length]


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class HeaderReader(DataSourceReader):
    def __init__(self, folder: str, pattern: str, files_per_task: int):
        self.folder, self.pattern, self.files_per_task = folder, pattern, files_per_task

    def partitions(self) -> list[FileGroup]:
        files, root = _file_system(self.folder)
        found = files.get_file_info(fs.FileSelector(root, recursive=True))
        paths = sorted(f.path for f in found if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern))
        groups = [FileGroup(paths[at : at + self.files_per_task]) for at in range(0, len(paths), self.files_per_task)]
        return groups or [FileGroup([])]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(self.folder)
        for at in range(0, len(partition.paths), ROWS_PER_BATCH):
            rows = [(path, *_header(files, path)) for path in partition.paths[at : at + ROWS_PER_BATCH]]
            kinds = (pa.string(), HEADER_KIND, pa.string(), pa.int64())
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "metadata", "error", "bytes_read"])


class ImageHeaders(DataSource):
    """``spark.read.format("image_headers").load(folder)``, with the options ``pathGlobFilter`` and ``filesPerTask``.

    A file that is no image, ends inside its header or cannot be opened has an ``error``.
    """

    @classmethod
    def name(cls) -> str:
        return "image_headers"

    def schema(self) -> str:
        return DDL

    def reader(self, schema: StructType) -> HeaderReader:
        per_task = int(self.options.get("filesPerTask", FILES_PER_TASK))
        return HeaderReader(self.options["path"], self.options.get("pathGlobFilter", "*.dcm"), per_task)


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _header(files: fs.FileSystem, path: str) -> tuple[dict | None, str | None, int]:
    ranges = None
    try:
        with files.open_input_file(path) as stream:
            ranges = FileRanges(stream)
            found = read_header(ranges)
        return {name: found.get(name) for name in TAGS.values()}, None, ranges.bytes_read
    except (HeaderError, OSError) as problem:
        return None, str(problem), ranges.bytes_read if ranges else 0


def read_image_headers(
    spark: SparkSession, folder: str, pattern: str = "*.dcm", files_per_task: int = FILES_PER_TASK
) -> DataFrame:
    """``(file_path, metadata, error, bytes_read)`` of all image files below a folder that every task can open."""
    spark.dataSource.register(ImageHeaders)
    reader = spark.read.format("image_headers").option("pathGlobFilter", pattern)
    return reader.option("filesPerTask", files_per_task).load(folder)
