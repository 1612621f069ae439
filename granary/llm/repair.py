"""Repair of conversation structure by cheapest edits, found by divide and conquer in linear space.

A conversation's roles must read `(s?(ua)+)?`. Four states follow them: nothing yet, after a system row, a user row, an
assistant row. Each row is kept, given another role or deleted, with empty rows inserted before it or at the end. What a row
does to the states is a 4 x 4 matrix of (cost, rank of the edits' initials among those that leave one state): edits of two
paths never are a prefix of each other, as every row's edits end with its one letter that isn't an insertion, so ranks alone
order whole edit texts. A forward vector (costs and ranks) and a backward vector (costs) of four states meet in the
middle; the crossing with the least cost, then the least rank, is on the best path, and both halves follow in the same way.

Runs of CHUNK rows have a matrix too, and so do runs of CHUNK runs. So long conversations are solved in parts: matrices go
up, the states at the ends of each part come down, and no task sees more than CHUNK rows or parts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import running_start, ship, spread
from granary.staging import stage

CHUNK = 1024

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: Cost of ending in each state, and the rows inserted there.
TAIL = (0, 2 * INSERT, INSERT, 0)
_TAIL_EDITS = ("", "II", "I", "")
_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
_NEVER = 1 << 60
#: Codes of a row: 4 * fault + role.
_ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FINE, TRUNCATED_ROW, BLANK, DUPLICATE = range(4)

_SPACE = r"[\x20\x09-\x0D]"

Vector = tuple[tuple[int, int], ...]
Matrix = tuple[Vector, ...]


def _accepts(state: int, role: int) -> bool:
    return role == _AFTER[state] or (state == START and role == SYSTEM)


@lru_cache(maxsize=None)
def row_steps(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest (cost, edits) of one row from each state to each other, ties to the least text."""
    fault, role = divmod(code, 4)
    late = TRUNCATED if fault == TRUNCATED_ROW else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for state in range(4):
        at = state
        for inserted in range(3):
            options = [(at, DELETE, "D")]
            if fault in (FINE, TRUNCATED_ROW):
                options.append((_AFTER[at], REROLE + late, "R"))
                if role and _accepts(at, role):
                    options.append((role, KEEP + late, "K"))
            for to, cost, letter in options:
                found = (cost + INSERT * inserted, "I" * inserted + letter)
                best[state, to] = min(best.get((state, to), found), found)
            at = _AFTER[at]
    return best


def _ranked(entries: list[tuple[int, object] | None]) -> Vector:
    order = sorted({e[1] for e in entries if e})
    return tuple((e[0], order.index(e[1])) if e else (_NEVER, 0) for e in entries)


@lru_cache(maxsize=None)
def row_matrix(code: int) -> Matrix:
    steps = row_steps(code)
    return tuple(_ranked([steps.get((p, q)) for q in range(4)]) for p in range(4))


def unit(state: int) -> Vector:
    return tuple((0 if s == state else _NEVER, 0) for s in range(4))


@lru_cache(maxsize=1 << 14)
def _forward(vector: Vector, matrix: Matrix) -> tuple[int, Vector]:
    """The vector after a matrix, less its least cost, and that cost."""
    entries = []
    for q in range(4):
        entries.append(min(
            ((c + matrix[p][q][0], (r, matrix[p][q][1])) for p, (c, r) in enumerate(vector) if c < _NEVER and matrix[p][q][0] < _NEVER),
            default=None,
        ))
    least = min(e[0] for e in entries if e)
    return least, tuple((c - least if c < _NEVER else c, r) for c, r in _ranked(entries))


@lru_cache(maxsize=1 << 14)
def _backward(matrix: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a matrix, from those after it, less the least."""
    found = [min(min(m[0] + c for m, c in zip(row, costs)), _NEVER) for row in matrix]
    least = min(found)
    return tuple(c - least if c < _NEVER else c for c in found)


def run_matrix(items: list[Matrix]) -> Matrix:
    """The matrix of several items one after the other."""
    rows = []
    for p in range(4):
        vector, total = unit(p), 0
        for item in items:
            least, vector = _forward(vector, item)
            total += least
        rows.append(tuple((c + total if c < _NEVER else c, r) for c, r in vector))
    return tuple(rows)


def crossings(items: list[Matrix], start: int, end: int) -> list[int]:
    """States before the first item, between items and after the last, on the cheapest path from `start` to
    `end` whose edits read least: forward and backward vectors meet mid-way, then each half is solved alone."""
    states = [start] * (len(items) + 1)
    states[-1] = end
    todo = [(0, len(items))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        before = unit(states[low])
        for item in items[low:middle]:
            before = _forward(before, item)[1]
        after = tuple(0 if s == states[high] else _NEVER for s in range(4))
        for item in reversed(items[middle:high]):
            after = _backward(item, after)
        states[middle] = min(range(4), key=lambda s: (before[s][0] + after[s], before[s][1]))
        todo += [(low, middle), (middle, high)]
    return states


def final_state(matrix: Matrix) -> int:
    """Where the best path of a whole conversation ends, before the rows inserted at its end."""
    return min(range(4), key=lambda s: (matrix[START][s][0] + TAIL[s], matrix[START][s][1]))


@lru_cache(maxsize=1 << 12)
def edits(codes: bytes, start: int, end: int) -> tuple[int, str]:
    """Cost and initials of the best edits of a run of rows between two states."""
    states = crossings([row_matrix(c) for c in codes], start, end)
    steps = [row_steps(c)[p, q] for c, p, q in zip(codes, states, states[1:])]
    return sum(c for c, _ in steps), "".join(e for _, e in steps)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) with faults made by crc32(`conv_id:turn`) % 20, nulls read as one space:
    0 drops the row (copy is null), 1 empties its text, 2 removes its `[.!?]`, 3 repeats it (copy 0 and 1), 4 makes its role user."""
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", "")).otherwise(_text("text"))
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(_text("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    )


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("same", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """A row per run of `chunk` rows of a conversation: (conv_id, part, matrix, codes, turns, roles).

    Texts stay behind: only turn, role initial, fault and a hash of role and text are shuffled.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends_well = F.col("text").rlike(rf"[.!?]{_SPACE}*\z")
    light = _keyed(rows.where("copy is not null")).select(
        "conv_id", "turn", "same", "copy", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(ends_well, FINE).otherwise(TRUNCATED_ROW).alias("fault"), F.lit(1).cast("long").alias("_one"),
    )
    placed = stage(running_start(light, ["conv_id"], ["turn", "same", "copy"], "_one", "place").drop("_one"), "placed")
    # A row is a duplicate where its role and text stood at an earlier place; the minimum is combined before the shuffle.
    first = placed.groupBy("conv_id", "same").agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = first.select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), "_first")
    coded = placed.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left").select(
        "conv_id", F.expr(f"place div {chunk}").alias("part"), "place", "turn", "initial",
        F.when((F.col("fault") != BLANK) & (F.col("place") > F.col("_first")), DUPLICATE).otherwise(F.col("fault")).alias("fault"),
    )
    runs = coded.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("place", "turn", "initial", "fault"))).alias("rows"))
    runs = runs.select("conv_id", "part", F.col("rows.turn").alias("turns"), F.col("rows.initial").alias("roles"), F.col("rows.fault").alias("faults"))

    def coded_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, matrices, illegal = [], [], []
            for initials, faults in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                found = bytes(4 * f + _ROLES.get(i, 0) for i, f in zip(initials, faults))
                codes.append(found)
                matrices.append(_packed(run_matrix([row_matrix(c) for c in found])))
                illegal.append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(codes, pa.binary()), pa.array(matrices, pa.list_(pa.int64())), pa.array(illegal, pa.int64())],
                [*batch.schema.names[:4], "codes", "matrix", "illegal"],
            )

    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    made = runs.mapInArrow(
        coded_runs, f"conv_id {conv}, part long, turns array<{turn}>, roles array<string>, codes binary, matrix array<long>, illegal long"
    )
    known = F.filter("turns", lambda t: t.isNotNull())
    return made.select(
        "conv_id", "part", "codes", "matrix", "illegal",
        F.element_at("roles", 1).alias("first_initial"), F.element_at("roles", -1).alias("last_initial"),
        F.when(F.size(known) > 0, F.element_at(known, 1)).alias("low"), F.when(F.size(known) > 0, F.element_at(known, -1)).alias("high"),
        F.size(F.array_distinct(known)).cast("long").alias("turns"),
    )


def _packed(matrix: Matrix) -> list[int]:
    return [x for row in matrix for entry in row for x in entry]


def _unpacked(values) -> Matrix:
    at = [int(x) for x in values]
    return tuple(tuple((at[8 * p + 2 * q], at[8 * p + 2 * q + 1]) for q in range(4)) for p in range(4))


def _ends(parts: DataFrame, chunk: int) -> DataFrame:
    """(conv_id, part, start, end): the states at both ends of each part, solved over parts of parts."""
    conv = parts.schema["conv_id"].dataType.simpleString()
    levels = [parts.select("conv_id", "part", "matrix")]
    widest = (levels[0].agg(F.max("part")).first()[0] or 0) + 1
    while widest > 1:

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [_packed(run_matrix([_unpacked(m) for m in below])) for below in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "matrix"])

        group = levels[-1].groupBy("conv_id", F.expr(f"part div {chunk}").alias("part")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("part").alias("at"), "matrix"))).alias("below")
        ).select("conv_id", "part", F.col("below.matrix").alias("below"))
        levels.append(stage(
            group.mapInArrow(joined, f"conv_id {conv}, part long, below array<array<long>>, matrix array<long>"), "parts"
        ))
        widest = -(-widest // chunk)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [final_state(_unpacked(m)) for m in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([START] * len(ends), pa.int32()), pa.array(ends, pa.int32())],
                ["conv_id", "part", "start", "end"],
            )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, starts, ends = [], [], [], []
            for i, (part, below, start, end) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                states = crossings([_unpacked(m) for m in below], start, end)
                keys += [i] * len(below)
                places += range(part * chunk, part * chunk + len(below))
                starts += states[:-1]
                ends += states[1:]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), pa.array(places, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["conv_id", "part", "start", "end"],
            )

    schema = f"conv_id {conv}, part long, start int, end int"
    solved = levels[-1].select("conv_id", "part", "matrix").mapInArrow(whole, schema)
    for level in reversed(levels[1:]):
        solved = _with_ends(level.select("conv_id", "part", "below"), solved).mapInArrow(split, schema)
    return solved


def _with_ends(parts: DataFrame, solved: DataFrame) -> DataFrame:
    known = solved.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "start", "end")
    return parts.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).drop("_conv", "_part")


def _audited(rows: DataFrame, chunk: int) -> DataFrame:
    """A row per part: what it holds, the states at its ends, and the initials and cost of its edits."""
    parts = stage(_chunks(rows, chunk), "chunks")

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            codes, starts, ends = (batch.column(names.index(c)).to_pylist() for c in ("codes", "start", "end"))
            found = [edits(c, p, q) for c, p, q in zip(codes, starts, ends)]
            faults = [np.bincount(np.frombuffer(c, np.uint8) // 4, minlength=4) for c in codes]
            more = {
                "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([e for _, e in found], pa.string()),
                "blank": pa.array([int(f[BLANK]) for f in faults], pa.int64()),
                "duplicate": pa.array([int(f[DUPLICATE]) for f in faults], pa.int64()),
                "truncated": pa.array([int(f[TRUNCATED_ROW]) for f in faults], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*names, *more])

    joined = _with_ends(parts.drop("matrix"), _ends(parts, chunk))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields)
    return joined.mapInArrow(solved, f"{fields}, cost long, audit string, blank long, duplicate long, truncated long")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: A conversation's head comes first, then its parts' audits, then its rows.
_HEAD, _PART, _ROW = range(3)


class _Conversation:
    """Folds the parts of one conversation, in order, then walks its edits row by row."""

    def __init__(self, key):
        self.key = key
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.last_initial = None
        self.audits: list[str] = []
        self.audit, self.at, self.state, self.end = "", 0, START, START

    def add(self, part: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
            self.counts[name] += part[name]
        if self.last_initial is not None and self.last_initial + part["first_initial"] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last_initial = part["last_initial"]
        # gaps counts distinct turns until close() turns it into what is missing between the first and the last.
        self.counts["gaps"] += part["turns"] - (self.high is not None and self.high == part["low"])
        if part["low"] is not None:
            self.low = part["low"] if self.low is None else self.low
            self.high = part["high"]
        self.audits.append(part["audit"])
        self.end = part["end"]

    def close(self) -> None:
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.counts["gaps"]
        self.counts["cost"] += TAIL[self.end]
        self.audit = "".join(self.audits) + _TAIL_EDITS[self.end]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at: self.at + 1] == "I":
            self.at += 1
            self.state = _AFTER[self.state]
            yield "I", _ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = _AFTER[self.state]
            role = _ROLE[self.state]
        elif edit == "K":
            self.state = _ROLES[role[0]]
        yield edit, role, text


def _walked(rows: DataFrame, chunk: int) -> DataFrame:
    """The edits of all conversations in order, after one head row (edit is empty) each with its counts and audit.

    Texts are shuffled once, by conversation. A conversation's rows stream through one task, sorted by Spark: a digest
    of all of them can't be made in parts. The task holds one letter per row.
    """
    parts = _audited(rows, chunk)
    conv = rows.schema["conv_id"].dataType
    inner = [f for f in parts.columns if f not in ("conv_id", "part", "codes", "start")]
    none = F.lit(None)
    heads = rows.groupBy("conv_id").agg(F.lit(_HEAD).alias("kind"))
    streams = [
        heads.select("conv_id", "kind", none.cast("long").alias("part"), none.cast(rows.schema["turn"].dataType).alias("turn"),
                     none.cast("binary").alias("same"), none.cast("int").alias("copy"), none.cast("string").alias("role"),
                     none.cast("string").alias("text"), none.cast(parts.select(F.struct(*inner)).schema[0].dataType).alias("found")),
        parts.select("conv_id", F.lit(_PART).alias("kind"), "part", none.cast(rows.schema["turn"].dataType).alias("turn"),
                     none.cast("binary").alias("same"), none.cast("int").alias("copy"), none.cast("string").alias("role"),
                     none.cast("string").alias("text"), F.struct(*inner).alias("found")),
    ]
    lines = _keyed(rows.where("copy is not null")).select(
        "conv_id", F.lit(_ROW).alias("kind"), none.cast("long").alias("part"), "turn", "same", "copy", "role", "text",
        none.cast(streams[1].schema["found"].dataType).alias("found"),
    )
    ordered = spread(streams[0].union(streams[1]).union(lines), "conv_id").sortWithinPartitions(
        "conv_id", "kind", "part", "turn", "same", "copy"
    ).select("conv_id", "kind", "role", "text", "found")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: _Conversation | None = None
        opened = False
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * (5 + len(_COUNTS))
            kinds = [key_type, pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(_COUNTS), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "edit", "role", "text", *_COUNTS, "audit"])

        def head() -> None:
            talk.close()
            out.append((talk.key, "", None, None, *[talk.counts[c] for c in _COUNTS], talk.audit))

        def put(found: Iterator[tuple[str, str, str]]) -> None:
            out.extend((talk.key, *step, *[None] * (len(_COUNTS) + 1)) for step in found)

        size = 0
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for key, kind, role, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _HEAD:
                    if talk is not None:
                        if not opened:
                            head()
                        put(talk.inserted())
                    talk, opened = _Conversation(key), False
                elif kind == _PART:
                    talk.add(found)
                else:
                    if not opened:
                        head()
                        opened = True
                    put(talk.row(role, text))
                    size += len(text)
                if len(out) >= 4096 or size > 1 << 22:
                    size = 0
                    yield emit()
        if talk is not None:
            if not opened:
                head()
            put(talk.inserted())
            yield emit()

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return ordered.mapInArrow(walk, f"conv_id {conv.simpleString()}, edit string, role string, text string, {counts}, audit string")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The edits of every conversation in order: (conv_id, edit, role, text), edit K, R, D or I.

    rows: conv_id, turn, role, text; other columns play no part. Nulls of role and text are one space; turns order a
    conversation, nulls first, equal turns by a hash of role and text. Repeated rows are duplicates but for the first. Without
    those whose edit is D, a conversation's rows read `(s?(ua)+)?`. A null conv_id is a conversation too; no rows give none.
    """
    ship(rows.sparkSession)
    given = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), F.lit(0).alias("copy"))
    return _walked(given, chunk).where("edit <> ''").select("conv_id", "edit", "role", "text")


def repair_digest(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) after `damaged`.

    A conversation without rows after the damage has zeros, an empty audit and the hash of nothing.
    """
    ship(conversations.sparkSession)
    walked = _walked(damaged(conversations), chunk)
    conv = conversations.schema["conv_id"].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, started = None, hashlib.sha256(), False
        out: list[tuple] = []
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, edit, role, text = row[:4]
                if edit == "":
                    if head:
                        out.append((*head, state.hexdigest()))
                    head, state, started = (key, *row[4:]), hashlib.sha256(), False
                elif edit != "D":
                    state.update(f"{chr(10) if started else ''}{role}:{text}".encode())
                    started = True
            if out:
                yield emitted(out, key_type)
        if head:
            out.append((*head, state.hexdigest()))
            yield emitted(out, key_type)

    def emitted(out: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        kinds = [key_type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return walked.mapInArrow(digested, f"conv_id {conv}, {counts}, audit string, repaired_sha256 string")
