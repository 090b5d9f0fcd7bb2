"""Column expressions. All of them are built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Formats of the date and time text in the records.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
LABEL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ref_to_id(reference: ColumnLike) -> Column:
    """``urn:uuid:x`` to ``x``; text without a colon is already an id."""
    return F.substring_index(column(reference), ":", -1)


def path_tail(path: ColumnLike) -> Column:
    return F.substring_index(column(path), "/", -1)


def url_tail(url: ColumnLike) -> Column:
    """Last path segment of a url; empty text when the url ends in a slash."""
    return F.regexp_extract(column(url), "([^/]+)$", 1)


def first_of(array: ColumnLike) -> Column:
    """First element, NULL for an empty or missing array (``getItem`` would raise under ANSI)."""
    return F.get(column(array), F.lit(0))


def join_displays(codings: ColumnLike, separator: str = ",") -> Column:
    return F.array_join(F.transform(column(codings), lambda coding: coding["display"]), separator)


def best_value(extension: ColumnLike, last: bool = False) -> Column:
    """The filled-in value of a typed extension: concept, address, code or text, in this order; with ``last`` the last
    one of them that is there, in which the displays of a concept follow each other without a comma."""
    ext = column(extension)
    place = ext["valueAddress"]
    values = [
        join_displays(ext["valueCodeableConcept"]["coding"], "" if last else ","),
        F.when(place.isNotNull(), F.concat_ws(", ", place["city"], place["state"])),
        ext["valueCode"],
        ext["valueString"],
    ]
    return F.coalesce(*(reversed(values) if last else values))


def period_bound(bound: ColumnLike, moment: ColumnLike) -> Column:
    return F.coalesce(column(bound), column(moment))


def parse_date(text: ColumnLike) -> Column:
    """Date prefix of a date or timestamp text; NULL when it is not a date."""
    return F.try_to_date(F.substring(column(text), 1, 10), DATE_FORMAT)


def parse_timestamp(text: ColumnLike) -> Column:
    """Instant of a text with zone offset and a fraction of up to nine digits; NULL when it does not parse.

    Digits beyond microseconds are cut off. The patterns are only tried where there is a point.
    """
    raw = column(text)
    digits = F.regexp_extract(raw, r"^[^.]*\.([0-9]{1,9})[^0-9]", 1)
    whole = F.regexp_replace(raw, r"^([^.]*)\.[0-9]{1,9}([^0-9])", "$1.#$2")
    micros = F.rpad(F.substring(digits, 1, 6), 6, "0")
    plain = F.when(~F.contains(raw, F.lit(".")), raw).when(digits == "", raw)
    return F.try_to_timestamp(plain.otherwise(F.replace(whole, F.lit("#"), micros)), F.lit(TIMESTAMP_FORMAT))


def struct_from_json(text: ColumnLike, ddl: str) -> Column:
    return F.from_json(column(text), ddl)


array_from_json = struct_from_json


def epoch_label(seconds: ColumnLike) -> Column:
    """Epoch seconds as the readable label of a stream batch."""
    return F.date_format(F.timestamp_seconds(column(seconds)), LABEL_FORMAT)
