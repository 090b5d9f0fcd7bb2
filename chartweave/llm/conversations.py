"""Conversations repaired at least cost, with the weights of :mod:`turn_repair`.

Turns are sorted in ranges of about equal size, whatever conversation they belong to, and read in order. A
conversation that lies inside one range is finished there. Of one that reaches a range's edge, or is long, the turns
go on to a second pass, where its faults are found by grouping its texts, its pieces are solved one by one in any
task, and only the pieces' least paths are joined per conversation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_type, saved, slices
from .turn_repair import EMPTY, PIECE, Joined, all_paths, n_illegal, repaired

SPACE = r"[\x20\x09-\x0D]"
#: a conversation with more turns or longer texts is taken piece by piece
LONG_TURNS = 1024
LONG_TEXT = 4 << 20
#: rows of one output batch
OUT_ROWS = 1024

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = ", ".join([*(f"{c} bigint" for c in COUNTS), "audit string", "repaired string"])
TURN = "turn bigint, role string, text string, fault string, present boolean"
PATHS = "paths array<struct<start: int, `end`: int, cost: bigint, audit: string>>"
FAULTS = ("blank", "duplicate", "truncated")


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per conversation: ``(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired)``.

    A conversation's turns are taken by turn number (nulls first), then role, then a hash of the text; equal rows are
    neighbours. Each turn has at most one fault: blank text, a role and text that came before, or a last visible
    character other than ``. ! ?``. ``illegal`` counts neighbours whose role initials are not su, ua or au, ``gaps``
    the missing turn numbers between the least and the greatest. ``audit`` is the cheapest list of edits (Keep,
    Rerole, Delete, Insert; ties: the least text) after which the role initials read ``(s?(ua)+)?``, and
    ``repaired`` the lines ``role:text`` that they leave.

    A null role or text counts as one space. Null conversation ids are one conversation. Rows where ``present`` is
    not true only name their conversation; one without turns has zeros and empty texts, and an empty table gives no
    rows. Other columns are not read. ``ranges`` is by default ``spark.sql.shuffle.partitions``; a conversation's
    turns may lie in many of them. Only its repaired text, one value of the result, comes together in one task.
    """
    kind = id_type(rows, conv_col)
    text, role = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (text_col, role_col))
    fault = F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(~text.rlike(rf"[.!?]{SPACE}*\z"), "truncated")
    turns = rows.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.coalesce(fault, F.lit("")).alias("fault"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        F.xxhash64(text).alias("mark"),
        F.monotonically_increasing_id().alias("row"),  # only deals equal rows to several ranges
    )
    order = ["conv", "turn", "role", "mark", "row"]
    number = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = turns.repartitionByRange(number, *order).sortWithinPartitions(*order).drop("mark", "row")
    first = saved(turns.mapInArrow(_finish_inner, f"conv {kind}, {REPORT}, place bigint, range int, {TURN}"))
    done = first.where("place IS NULL").select("conv", *COUNTS, "audit", "repaired")
    rest = _in_pieces(first.where("place IS NOT NULL").select("conv", "range", "place", *_names(TURN)), kind)
    return done.union(rest).withColumnRenamed("conv", conv_col)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _write(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded length and bytes of text."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= OUT_ROWS or size >= LONG_TEXT:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _with_first(batches: Iterator[pa.RecordBatch]) -> tuple[pa.RecordBatch | None, Iterator[pa.RecordBatch]]:
    first = next(batches, None)
    return first, iter(()) if first is None else (b for part in ((first,), batches) for b in part)


# --- conversations inside a range ------------------------------------------------------------------------------
def _finish_inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, batches = _with_first(batches)
    if first is None:
        return
    here = TaskContext.get().partitionId()
    conv, turn = first.schema.field("conv").type, [(f.name, f.type) for f in first.schema][1:]
    report = [*((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired", pa.string())]
    schema = pa.schema([("conv", conv), *report, ("place", pa.int64()), ("range", pa.int32()), *turn])
    yield from _write(_inner_rows(_read(slices(batches, "text")), here, len(report)), schema)


def _inner_rows(rows: Iterator[tuple], here: int, n_report: int) -> Iterator[tuple]:
    """Reports of the conversations that begin and end here; the turns of all others as they are."""

    def later(held):
        return [(row[0], *[None] * n_report, place, here, *row[1:]) for place, row in held]

    held: list[tuple[int, tuple]] = []
    opening, passing, size = True, False, 0  # the range's first conversation may have begun before it
    for place, row in enumerate(rows):
        if held and held[-1][1][0] != row[0]:
            if opening or passing:
                yield from later(held)
            else:
                yield (held[0][1][0], *_report([r[1:] for _, r in held]), *[None] * (len(row) + 1))
            held, opening, passing, size = [], False, False, 0
        held.append((place, row))
        size += len(row[3])
        if opening or passing or len(held) > LONG_TURNS or size > LONG_TEXT:
            passing = True
            yield from later(held[:-1])
            held = held[-1:]
    yield from later(held)  # the range's last conversation may go on behind it


def _report(rows: list[tuple]) -> tuple:
    """The finished row of a conversation whose turns ``(turn, role, text, fault, present)`` are all at hand."""
    turns, seen = [], set()
    for turn, role, text, fault, present in rows:
        if present:
            if fault != "blank":
                fault = "duplicate" if (role, text) in seen else fault
                seen.add((role, text))
            turns.append((turn, role, text, fault))
    join, parts = Joined(), []
    for at in range(0, len(turns), PIECE):
        parts.append(turns[at : at + PIECE])
        join.add(all_paths([(role[:1], fault) for _, role, _, fault in parts[-1]], join.heads))
    # the pieces' paths are found again rather than held
    cost, more, ways = join.finish()
    audit = [
        all_paths([(role[:1], fault) for _, role, _, fault in part], (way[0],))[way][1] for part, way in zip(parts, ways)
    ]
    lines, _ = repaired(((role, text) for _, role, text, _ in turns), "".join(audit) + "I" * more, EMPTY)
    counts = _counts(turns)
    return (*_totals([counts]), cost, "".join(audit) + "I" * more, "\n".join(lines))


def _counts(turns: list[tuple]) -> dict:
    """What a stretch of turns ``(turn, role, text, fault)`` tells about its conversation."""
    numbers = [t[0] for t in turns if t[0] is not None]
    found = {name: sum(t[3] == name for t in turns) for name in FAULTS}
    return {
        **found,
        "illegal": n_illegal(t[1][:1] for t in turns),
        "low": numbers[0] if numbers else None,
        "high": numbers[-1] if numbers else None,
        "distinct": len(set(numbers)),
        "head": turns[0][1][:1] if turns else None,
        "tail": turns[-1][1][:1] if turns else None,
    }


def _totals(parts: Iterable[dict]) -> tuple[int, ...]:
    """``(gaps, blank, duplicate, truncated, illegal)`` of a conversation from its stretches in order."""
    total = dict.fromkeys((*FAULTS, "illegal", "distinct"), 0)
    low = high = tail = None
    for part in parts:
        for name in total:
            total[name] += part[name]
        if part["head"] is not None:
            if tail is not None:
                total["illegal"] += n_illegal((tail, part["head"]))
            tail = part["tail"]
        if part["low"] is not None:
            total["distinct"] -= high == part["low"]  # the same number at the seam
            low = part["low"] if low is None else low
            high = part["high"]
    gaps = 0 if low is None else high - low + 1 - total["distinct"]
    return gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"]


# --- conversations over several ranges -------------------------------------------------------------------------
STRETCH = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, distinct bigint, head string, tail string"
TURNS = "turns array<struct<role: string, text: string>>"


def _in_pieces(rows: DataFrame, kind: str) -> DataFrame:
    """The same reports from turns numbered by ``range`` and ``place``."""
    seen = (
        rows.where("present AND fault <> 'blank'")
        .groupBy("conv", "role", F.sha2("text", 256).alias("content"))
        .agg(F.min(F.struct("range", "place")).alias("at"))
        .select("at.range", "at.place", F.lit(True).alias("first"))
    )
    fault = F.when((F.col("fault") != "blank") & F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))
    marked = rows.join(seen, ["range", "place"], "left").withColumn("fault", fault).drop("first")
    piece = F.floor(F.col("place") / PIECE)
    dealt = marked.withColumn("piece", piece).repartition("conv", "range", "piece")
    dealt = dealt.sortWithinPartitions("conv", "range", "piece", "place")
    dealt = dealt.select("conv", "range", "piece", "turn", "role", "text", "fault", "present")
    pieces = saved(dealt.mapInArrow(_solve_pieces, f"conv {kind}, range int, piece bigint, {STRETCH}, {PATHS}, {TURNS}"))

    order = ["conv", "range", "piece"]
    paths = pieces.drop("turns").repartition("conv").sortWithinPartitions(*order)
    ways = paths.mapInArrow(_join_pieces, f"conv {kind}, range int, piece bigint, start int, edits string, {REPORT}")
    ways = ways.drop("audit", "repaired").withColumnsRenamed({"conv": "_conv", "range": "_range", "piece": "_piece"})
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("range") == F.col("_range")) & (F.col("piece") == F.col("_piece"))
    lines = pieces.select(*order, "turns").join(ways, same).select(*order, "start", "edits", *COUNTS, "turns")
    lines = lines.repartition("conv").sortWithinPartitions(*order)
    return lines.mapInArrow(_write_lines, f"conv {kind}, {REPORT}")


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, batches = _with_first(batches)
    if first is None:
        return
    count = [(name.split()[0], pa.string() if name.endswith("string") else pa.int64()) for name in STRETCH.split(", ")]
    path = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    keys = [first.schema.field(n) for n in ("conv", "range", "piece")]
    schema = pa.schema([*keys, *count, ("paths", pa.list_(path)), ("turns", pa.list_(turn))])

    def solved():
        for key, rows in groupby(_read(slices(batches, "text")), lambda r: r[:3]):
            turns = [row[3:7] for row in rows if row[7]]
            paths = all_paths([(role[:1], fault) for _, role, _, fault in turns])
            yield (
                *key,
                *_counts(turns).values(),
                [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in paths.items()],
                [{"role": role, "text": text} for _, role, text, _ in turns],
            )

    for row in solved():
        yield from _write([row], schema)


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each piece starts and its edits; the conversation's counts stand in its last piece."""
    first, batches = _with_first(batches)
    if first is None:
        return
    keys = [first.schema.field(n) for n in ("conv", "range", "piece")]
    counts = [(c, pa.int64()) for c in COUNTS]
    texts = [("audit", pa.string()), ("repaired", pa.string())]
    schema = pa.schema([*keys, ("start", pa.int32()), ("edits", pa.string()), *counts, *texts])
    names = [name.split()[0] for name in STRETCH.split(", ")]

    def joined():
        for _, group in groupby(_read(batches), lambda r: r[0]):
            join, found, parts = Joined(), [], []
            for row in group:
                paths = {(p["start"], p["end"]): (p["cost"], p["audit"]) for p in row[-1]}
                join.add(paths)
                found.append((row[:3], {way: audit for way, (_, audit) in paths.items()}))
                parts.append(dict(zip(names, row[3:])))
            cost, more, ways = join.finish()
            for place, ((key, audits), way) in enumerate(zip(found, ways), 1):
                last = place == len(found)
                tail = (*_totals(parts), cost) if last else (None,) * len(COUNTS)
                yield (*key, way[0], audits[way] + "I" * (more if last else 0), *tail, None, None)

    yield from _write(joined(), schema)


def _write_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, batches = _with_first(batches)
    if first is None:
        return
    report = [*((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired", pa.string())]
    schema = pa.schema([first.schema.field("conv"), *report])

    def written():
        for conv, group in groupby(_read(batches), lambda r: r[0]):
            audit, lines, counts = [], [], ()
            for _, _, _, start, edits, *rest in group:
                counts, turns = rest[:-1], rest[-1]
                audit.append(edits)
                lines += repaired(((t["role"], t["text"]) for t in turns), edits, start)[0]
            yield (conv, *counts, "".join(audit), "\n".join(lines))

    for row in written():
        yield from _write([row], schema)
