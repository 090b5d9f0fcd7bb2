"""Header fields and pixels of image files.

Spark distributes the files; inside a task each file is walked once, straight from the Arrow buffer.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (group, element) numbers of the header and pixel fields, value types with a long length
# field and the two uncompressed little-endian transfer syntaxes, from the public DICOM standard.
TAGS = {
    (0x0010, 0x0020): "PatientID",
    (0x0008, 0x0020): "StudyDate",
    (0x0008, 0x0060): "Modality",
    (0x0008, 0x1030): "StudyDescription",
    (0x0008, 0x103E): "SeriesDescription",
}
PIXEL_TAGS = {
    (0x0028, 0x0002): "samples",
    (0x0028, 0x0006): "planar",
    (0x0028, 0x0008): "frames",
    (0x0028, 0x0010): "rows",
    (0x0028, 0x0011): "columns",
    (0x0028, 0x0100): "bits",
    (0x0028, 0x0103): "signed",
    (0x7FE0, 0x0010): "pixels",
}
LONG_FORMS = {b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"}
TRANSFER_SYNTAX = (0x0002, 0x0010)
IMPLICIT_LITTLE = "1.2.840.10008.1.2"
EXPLICIT_LITTLE = "1.2.840.10008.1.2.1"
ITEM, ITEM_END, SEQUENCE_END = (0xFFFE, 0xE000), (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
UNDEFINED = 0xFFFFFFFF
LAST_TAG = (0x0010, 0x0020)

METADATA_DDL = "STRUCT<" + ", ".join(f"{name}: STRING" for name in TAGS.values()) + ">"


class HeaderError(ValueError):
    pass


#: longest value that is read; the wanted header fields have 64 characters at most
LONGEST_TEXT = 1 << 20


class InMemory:
    """The bytes of a whole file by offset, as a file that is read in ranges gives them."""

    def __init__(self, data: memoryview):
        self._data, self.size = data, len(data)

    def at(self, offset: int, length: int) -> memoryview:
        return self._data[offset : offset + length]


def _element(data, at: int, explicit: bool) -> tuple[tuple[int, int], int, int]:
    """Tag, value length and value offset of the element at ``at``."""
    head = data.at(at, 12)
    group, number = struct.unpack_from("<HH", head, 0)
    if group == 0xFFFE or not explicit:
        return (group, number), struct.unpack_from("<I", head, 4)[0], at + 8
    if bytes(head[4:6]) in LONG_FORMS:
        return (group, number), struct.unpack_from("<I", head, 8)[0], at + 12
    return (group, number), struct.unpack_from("<H", head, 6)[0], at + 8


def _skip_sequence(data, at: int, explicit: bool) -> int:
    """Offset behind a sequence or item of undefined length."""
    depth = 1
    while depth:
        tag, length, at = _element(data, at, explicit)
        if tag in (ITEM_END, SEQUENCE_END):
            depth -= 1
        elif length == UNDEFINED:
            depth += 1
        elif tag != ITEM:
            at += length
    return at


def read_elements(
    data, wanted: dict[tuple[int, int], str], last: tuple[int, int], longest: int | None = None
) -> dict[str, bytes]:
    """Raw values of the wanted top-level fields, up to the tag ``last``.

    ``data`` is a file's content, or gives its bytes by offset (``size`` and ``at``). Of other fields only the tag and
    length are looked at.
    """
    data = data if hasattr(data, "at") else InMemory(data)
    if data.size < 132 or bytes(data.at(128, 4)) != b"DICM":
        raise HeaderError("not an image file: no DICM marker")
    found: dict[str, bytes] = {}
    at, syntax = 132, EXPLICIT_LITTLE
    try:
        while at + 8 <= data.size:
            in_meta = struct.unpack_from("<H", data.at(at, 2), 0)[0] == 0x0002
            if not in_meta and syntax not in (EXPLICIT_LITTLE, IMPLICIT_LITTLE):
                raise HeaderError(f"transfer syntax {syntax} is not supported")
            explicit = in_meta or syntax == EXPLICIT_LITTLE
            tag, length, at = _element(data, at, explicit)
            if tag > last:
                break
            if length == UNDEFINED:
                at = _skip_sequence(data, at, explicit)
                continue
            if at + length > data.size:
                raise HeaderError("header ends inside an element")
            if tag in wanted or tag == TRANSFER_SYNTAX:
                if longest is not None and length > longest:
                    raise HeaderError(f"a header field of {length} bytes")
                value = bytes(data.at(at, length))
                if tag in wanted:
                    found[wanted[tag]] = value
                else:
                    syntax = _text(value)
            at += length
    except struct.error as problem:
        raise HeaderError("header ends inside an element") from problem
    return found


def _text(value: bytes | memoryview) -> str:
    return bytes(value).decode("latin-1").strip(" \0")


def read_header(data) -> dict[str, str]:
    """The wanted header fields of one file; raises :class:`HeaderError` for anything unreadable."""
    return {name: _text(value) for name, value in read_elements(data, TAGS, LAST_TAG, LONGEST_TEXT).items()}


def read_pixels(data: memoryview) -> np.ndarray | None:
    """All pixel values of one uncompressed image, row by row; NULL for a file without pixels."""
    found = read_elements(data, PIXEL_TAGS, max(PIXEL_TAGS))
    if "pixels" not in found:
        return None

    def number(name: str, default: int) -> int:
        return int.from_bytes(found[name][:2], "little") if name in found else default

    bits, samples = number("bits", 16), number("samples", 1)
    if bits not in (8, 16, 32):
        raise HeaderError(f"{bits} bits per pixel are not supported")
    frames = int(_text(found["frames"])) if "frames" in found else 1
    area = number("rows", 0) * number("columns", 0)
    kind = f"<{'i' if number('signed', 0) else 'u'}{bits // 8}"
    if len(found["pixels"]) < area * samples * frames * bits // 8:
        raise HeaderError("fewer pixels than the header says")
    values = np.frombuffer(found["pixels"], kind, area * samples * frames)
    if number("planar", 0) == 1:
        values = values.reshape(frames, samples, area).transpose(0, 2, 1).ravel()
    return values


HEADER_KIND = pa.struct([(name, pa.string()) for name in TAGS.values()])
PIXEL_KIND = pa.list_(pa.string())


def _attempt(read, content: pa.BinaryScalar) -> tuple:
    """The value read from one file's content, or NULL and the reason."""
    try:
        if not content.is_valid:
            raise HeaderError("no content")
        return read(memoryview(content.as_buffer())), None
    except ValueError as problem:  # HeaderError, and numbers that are none
        return None, str(problem)


def _header_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = [_attempt(read_header, content) for content in batch.column("content")]
        values = [None if header is None else {n: header.get(n) for n in TAGS.values()} for header, _ in results]
        columns = [batch.column("file_path"), pa.array(values, HEADER_KIND), pa.array([e for _, e in results], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["file_path", "metadata", "error"])


def _image_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One output batch per image, made in Arrow, so a task holds the text of one image at a time."""
    for batch in batches:
        for i, content in enumerate(batch.column("content")):
            header, error = _attempt(read_header, content)
            pixels, problem = _attempt(read_pixels, content) if error is None else (None, error)
            if pixels is None:
                texts = pa.array([None], PIXEL_KIND)
            else:
                texts = pa.ListArray.from_arrays(pa.array([0, len(pixels)], pa.int32()), pa.array(pixels).cast(pa.string()))
            row = None if header is None else {n: header.get(n) for n in TAGS.values()}
            columns = [batch.column("file_path").slice(i, 1), pa.array([row], HEADER_KIND), texts, pa.array([problem], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "metadata", "image_data", "error"])


def _file_content(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias("file_path"), "content")


def dicom_metadata(files: DataFrame) -> DataFrame:
    """``(path, content)`` rows to ``(file_path, metadata, error)``; a missing field is NULL."""
    return _file_content(files).mapInArrow(
        _header_batches, f"file_path STRING, metadata {METADATA_DDL}, error STRING"
    )


def dicom_images(files: DataFrame) -> DataFrame:
    """Like :func:`dicom_metadata`, with the pixel values as text in ``image_data``; each file is read once.

    ``error`` may say why there are no pixels while the header is there.
    """
    return _file_content(files).mapInArrow(
        _image_batches,
        f"file_path STRING, metadata {METADATA_DDL}, image_data ARRAY<STRING>, error STRING",
    )


def imaging_inventory(metadata: DataFrame, patients: DataFrame) -> DataFrame:
    """Image counts per modality and study date, and how many belong to a known patient.

    Images are counted per patient before the join, so a patient with very many images stays cheap.
    """
    per_patient = (
        metadata.where(F.col("metadata").isNotNull())
        .groupBy(
            F.col("metadata.Modality").alias("modality"),
            F.col("metadata.StudyDate").alias("study_date"),
            F.col("metadata.PatientID").alias("patient_id"),
        )
        .agg(F.count("*").alias("images"))
    )
    known = patients.select("patient_id").distinct().withColumn("is_known", F.lit(1))
    return (
        per_patient.join(known, "patient_id", "left")
        .groupBy("modality", "study_date")
        .agg(
            F.sum("images").alias("n_images"),
            F.coalesce(F.sum(F.when(F.col("is_known") == 1, F.col("images"))), F.lit(0)).alias("n_known_patient"),
        )
    )
