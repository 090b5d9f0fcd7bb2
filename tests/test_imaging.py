from __future__ import annotations

import struct

import pytest

from chartweave.operators.imaging import HeaderError, dicom_images, dicom_metadata, read_header, read_pixels
from chartweave.sources.image_headers import BLOCK, read_image_headers
from chartweave.sources.images import read_images


def element(group, number, kind, value, explicit=True):
    if len(value) % 2:
        value += b" "
    tag = struct.pack("<HH", group, number)
    if not explicit:
        return tag + struct.pack("<I", len(value)) + value
    if kind in (b"OB", b"OW", b"SQ", b"UN"):
        return tag + kind + b"\0\0" + struct.pack("<I", len(value)) + value
    return tag + kind + struct.pack("<H", len(value)) + value


def image(syntax=b"1.2.840.10008.1.2.1", explicit=True, body=b""):
    head = b"\0" * 128 + b"DICM" + element(2, 0x10, b"UI", syntax + b"\0" * (len(syntax) % 2))
    return head + body + element(0x10, 0x20, b"LO", b"patient-1", explicit) + element(0x7FE0, 0x10, b"OW", b"\1\2", explicit)


def test_explicit_and_implicit():
    body = element(8, 0x20, b"DA", b"20200102") + element(8, 0x60, b"CS", b"CT")
    assert read_header(memoryview(image(body=body))) == {"PatientID": "patient-1", "StudyDate": "20200102", "Modality": "CT"}
    plain = element(8, 0x1030, b"", b"Chest", explicit=False)
    assert read_header(memoryview(image(b"1.2.840.10008.1.2", False, plain))) == {"PatientID": "patient-1", "StudyDescription": "Chest"}


@pytest.mark.parametrize("explicit, syntax", [(True, b"1.2.840.10008.1.2.1"), (False, b"1.2.840.10008.1.2")])
def test_sequences_are_skipped(explicit, syntax):
    inner = element(8, 0x60, b"CS", b"no", explicit)
    item = struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF) + inner + struct.pack("<HHI", 0xFFFE, 0xE00D, 0)
    end = struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    long = b"SQ\0\0" if explicit else b""
    open_sequence = struct.pack("<HH", 8, 0x1140) + long + struct.pack("<I", 0xFFFFFFFF) + item + end
    closed = element(8, 0x1150, b"SQ", struct.pack("<HHI", 0xFFFE, 0xE000, len(inner)) + inner, explicit)
    assert read_header(memoryview(image(syntax, explicit, open_sequence + closed))) == {"PatientID": "patient-1"}


@pytest.mark.parametrize(
    "content, message",
    [
        (b"", "no DICM marker"),
        (b"x" * 200, "no DICM marker"),
        (image()[:150], "ends inside"),
        (image(b"1.2.840.10008.1.2.2"), "not supported"),
    ],
)
def test_unreadable(content, message):
    with pytest.raises(HeaderError, match=message):
        read_header(memoryview(content))


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.dcm").write_bytes(image(body=element(8, 0x60, b"CS", b"MR")))
    (tmp_path / "b.dcm").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"other")
    got = {r["file_path"].rsplit("/", 1)[1]: r for r in dicom_metadata(read_images(spark, str(tmp_path))).collect()}
    assert set(got) == {"a.dcm", "b.dcm"}
    assert got["a.dcm"]["metadata"]["Modality"] == "MR" and got["a.dcm"]["error"] is None
    assert got["b.dcm"]["metadata"] is None and "DICM" in got["b.dcm"]["error"]


def test_missing_content(spark):
    df = spark.createDataFrame([("p", None)], "path STRING, content BINARY")
    assert dicom_metadata(df).first()["error"] == "no content"


def us(number, value):
    return element(0x28, number, b"US", struct.pack("<H", value))


def pixels(values, kind, **tags):
    head = b"\0" * 128 + b"DICM"
    numbers = {"samples": 2, "planar": 6, "rows": 0x10, "columns": 0x11, "bits": 0x100, "signed": 0x103}
    body = b"".join(us(numbers[name], value) for name, value in sorted(tags.items(), key=lambda x: numbers[x[0]]))
    return head + body + element(0x7FE0, 0x10, b"OW", struct.pack(f"<{len(values)}{kind}", *values))


def test_pixels():
    assert read_pixels(memoryview(pixels([1, 255, 0, 7], "B", rows=2, columns=2, bits=8))).tolist() == [1, 255, 0, 7]
    assert read_pixels(memoryview(pixels([-5, 300], "h", rows=1, columns=2, bits=16, signed=1))).tolist() == [-5, 300]
    planes = pixels([1, 2, 3, 4, 5, 6], "B", rows=1, columns=2, bits=8, samples=3, planar=1)
    assert read_pixels(memoryview(planes)).tolist() == [1, 3, 5, 2, 4, 6]
    assert read_pixels(memoryview(b"\0" * 128 + b"DICM")) is None
    with pytest.raises(HeaderError, match="fewer pixels"):
        read_pixels(memoryview(pixels([1], "H", rows=4, columns=4, bits=16)))
    with pytest.raises(HeaderError, match="12 bits"):
        read_pixels(memoryview(pixels([1], "H", rows=1, columns=1, bits=12)))


def test_image_rows(spark):
    good = pixels([9, 8], "B", rows=1, columns=2, bits=8)
    short = pixels([9, 8], "B", rows=5, columns=2, bits=8)
    df = spark.createDataFrame([("a", good), ("b", b"x"), ("c", short)], "path STRING, content BINARY")
    got = {r["file_path"]: r for r in dicom_images(df).collect()}
    assert got["a"]["image_data"] == ["9", "8"] and got["a"]["error"] is None
    assert got["b"]["image_data"] is None and got["b"]["metadata"] is None and "DICM" in got["b"]["error"]
    assert got["c"]["image_data"] is None and got["c"]["metadata"] is not None and "fewer" in got["c"]["error"]


def test_files_of_any_size_are_read_in_ranges(spark, tmp_path):
    """A sparse file of 5 GB, a header with a value of 300 MB before the last field, and many small files."""
    (tmp_path / "many").mkdir()
    for n in range(25):
        (tmp_path / "many" / f"{n:02d}.dcm").write_bytes(image(body=element(8, 0x60, b"CS", b"CT")))
    with open(tmp_path / "large.dcm", "wb") as out:
        out.write(image())
        out.truncate(5 << 30)
    with open(tmp_path / "gap.dcm", "wb") as out:
        skipped = struct.pack("<HH", 9, 1) + b"OB\0\0" + struct.pack("<I", 300 << 20)
        out.write(image()[:132] + element(2, 0x10, b"UI", b"1.2.840.10008.1.2.1\0") + element(8, 0x60, b"CS", b"MR") + skipped)
        out.seek(300 << 20, 1)
        out.write(element(0x10, 0x20, b"LO", b"behind"))
    (tmp_path / "none.dcm").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(image())
    frame = read_image_headers(spark, str(tmp_path), files_per_task=10)
    assert frame.rdd.getNumPartitions() == 3
    found = {r.file_path.rsplit("/", 1)[1]: r for r in frame.collect()}
    assert len(found) == 28 and all(r.bytes_read <= 2 * BLOCK for r in found.values())
    assert (found["large.dcm"].metadata.PatientID, found["large.dcm"].bytes_read) == ("patient-1", BLOCK)
    assert (found["gap.dcm"].metadata.PatientID, found["gap.dcm"].metadata.Modality) == ("behind", "MR")
    assert found["03.dcm"].metadata.Modality == "CT" and "no DICM marker" in found["none.dcm"].error
    from_content = dicom_metadata(read_images(spark, str(tmp_path / "many"))).select("metadata", "error")
    assert sorted(from_content.collect()) == sorted((r.metadata, r.error) for n, r in found.items() if n[0].isdigit())


def test_a_field_longer_than_any_text_is_an_error(spark, tmp_path):
    head = image(b"1.2.840.10008.1.2", False)
    at = head.index(struct.pack("<HH", 0x10, 0x20))
    with open(tmp_path / "odd.dcm", "wb") as out:
        out.write(head[: at + 4] + struct.pack("<I", 1 << 30))
        out.truncate(2 << 30)
    row = read_image_headers(spark, f"file://{tmp_path}").first()
    assert row.metadata is None and "bytes" in row.error and row.bytes_read <= BLOCK
    assert read_image_headers(spark, str(tmp_path), "*.none").count() == 0
