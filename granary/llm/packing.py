"""Vector best-fit packing of token pieces into sequences.

A piece of n tokens needs (n tokens, 1 document, n^2 attention cost) of a sequence's capacities. The
demand depends on n alone and n is at most the sequence length, so the plan is made on the histogram of
lengths (one number per possible length, however many pieces there are), and carried out by
giving each piece the place that its rank among the pieces of its length has in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from granary.llm.common import running_start, ship
from granary.llm.tokens import public_path, word_tokenizer
from granary.staging import stage


#: Bytes of ids a worker holds before it hands on a batch.
BATCH_BYTES = 4 << 20


def _cut(
    docs: DataFrame, length: int, tokenizer: str, end_id: int | None, id_col: str, text_col: str, digest: bool
) -> DataFrame:
    """Pieces with their ids, or with the ids' crc32: then ids never leave the worker."""
    ship(docs.sparkSession)
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    name, kind = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = word_tokenizer(public_path(tokenizer) if "/" not in tokenizer else tokenizer)
        step = 4 * length
        for batch in batches:
            kinds = (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), kind)

            def taken(columns: list[list]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [id_col, "piece", "start", "length", name]
                )

            columns, held = [[], [], [], [], []], 0
            for key, found in zip(batch.column(0).to_pylist(), library.encode_all(batch.column(1))):
                ids = found.tobytes() + end
                for number, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at: at + step]
                    value = zlib.crc32(piece) if digest else piece
                    for column, cell in zip(columns, (key, number, at // 4, len(piece) // 4, value)):
                        column.append(cell)
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield taken(columns)
                    columns, held = [[], [], [], [], []], 0
            yield taken(columns)

    key_kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        cut, f"`{id_col}` {key_kind}, piece int, start long, length long, {name} {'long' if digest else 'binary'}"
    )


def piece_ids(
    docs: DataFrame,
    length: int = 2048,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token ids of every text in pieces of at most `length`:
    (id, piece, start, length, ids), ids as little-endian unsigned 32-bit integers.

    Only longer documents are cut; the last piece may be shorter. Null and empty texts have the end id
    alone (no piece if there is none). Repeated rows make repeated pieces.
    """
    return _cut(docs, length, tokenizer, end_id, id_col, text_col, False)


def piece_digests(
    docs: DataFrame,
    length: int = 2048,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """As `piece_ids`, with ids_crc32 (unsigned) in place of the ids."""
    return _cut(docs, length, tokenizer, end_id, id_col, text_col, True)


def plan_bins(
    counts: dict[int, int],
    capacity: int,
    max_documents: int,
    max_attention: int,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    select: str = "dot",
) -> list[tuple[dict[int, int], int]]:
    """Bins for `counts` pieces of each length: [(pieces per length in a bin, number of such bins)].

    A bin opens with the longest piece left. Then, of all lengths that fit under every capacity, it takes the
    one with the largest weighted dot product of demand and residual capacity (select="dot"), or
    that leaves the smallest weighted residual norm ("norm"); ties go to the longer. Both are taken as shares of
    the capacities. A bin's pattern is repeated while the counts last.
    """
    limits = np.array([capacity, max_documents, max_attention], float)
    sizes = np.array(sorted((n for n, c in counts.items() if c > 0), reverse=True), np.int64)
    left = np.array([counts[n] for n in sizes.tolist()], np.int64)
    demand = np.stack([sizes, np.ones_like(sizes), sizes * sizes], 1) / limits
    if (demand > 1).any():
        raise ValueError("a piece alone exceeds a capacity")
    weight = np.array(weights, float)
    bins = []
    while left.any():
        rest, taken = np.ones(3), np.zeros(len(sizes), np.int64)
        at = int(np.argmax(left > 0))
        while True:
            taken[at] += 1
            rest = rest - demand[at]
            fits = (left > taken) & (demand <= rest + 1e-12).all(1)
            if not fits.any():
                break
            if select == "dot":
                score = demand @ (weight * rest)
            else:
                score = -(((rest - demand) ** 2) @ weight)
            at = int(np.argmax(np.where(fits, score, -np.inf)))
        used = taken > 0
        times = int((left[used] // taken[used]).min())
        left = left - times * taken
        bins.append(({int(sizes[i]): int(taken[i]) for i in np.flatnonzero(used)}, times))
    return bins


def pack(
    pieces: DataFrame,
    keys: list[str],
    capacity: int = 2048,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    select: str = "dot",
    length_col: str = "length",
) -> DataFrame:
    """`pieces` plus sequence_id (0, 1, ...) and offset, gapless from 0 within a sequence.

    keys order the pieces of one length; if they are not unique, equal rows take equal roles
    in any order. Lengths must be 1 .. capacity. By default the document and attention capacities are those that a
    sequence of `capacity` tokens can reach, so they don't bind. An empty table stays empty.
    The driver sees one count per length; pieces are ranked by range partitions, so a
    length that a third of all pieces share is no task's alone.
    """
    clash = {"sequence_id", "offset", "_rank"} & set(pieces.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    max_documents = capacity if max_documents is None else max_documents
    max_attention = capacity * capacity if max_attention is None else max_attention
    ship(pieces.sparkSession)
    rows = stage(pieces, "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy(length_col).count().collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 .. {capacity}")
    # Per length: ranks from `low` on go to bins from `base` on, `each` to a bin, from `at`.
    places: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in counts}
    used, base = dict.fromkeys(counts, 0), 0
    for taken, times in plan_bins(counts, capacity, max_documents, max_attention, weights, select):
        at = 0
        for n, each in taken.items():
            places[n].append((used[n], base, each, at))
            used[n] += each * times
            at += n * each
        base += times
    tables = {n: np.array(p, np.int64) for n, p in places.items()}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sizes = batch.column(names.index(length_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(names.index("_rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for n in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == n)
                table = tables[n]
                step = table[np.searchsorted(table[:, 0], ranks[mine], side="right") - 1]
                k = ranks[mine] - step[:, 0]
                sequence[mine] = step[:, 1] + k // step[:, 2]
                offset[mine] = step[:, 3] + k % step[:, 2] * n
            kept = [i for i, name in enumerate(names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(sequence), pa.array(offset)],
                [*(names[i] for i in kept), "sequence_id", "offset"],
            )

    ranked = running_start(rows.withColumn("_one", F.lit(1).cast("long")), [length_col], keys, "_one", "_rank").drop("_one")
    schema = StructType(
        [*ranked.drop("_rank").schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    return ranked.mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, length: int = 2048, **options) -> DataFrame:
    """Digest of packed documents: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(piece_digests(docs, length, **options), ["doc_id", "piece"], capacity=length)
