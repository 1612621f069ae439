"""Mixing sources to target weights, by fixed-length blocks of words.

The words of a source, document after document, are cut into blocks of BLOCK_WORDS. Output shards
draw how many blocks they take of each source: a binary tree over the shards splits each
source's quota by a binomial draw at every node, so its counts over the shards are one multinomial draw that meets the
quota, and any shard finds its own by walking down from the root. Shards vary a little in size.
The k-th block a source gives is a pseudorandom permutation of k; blocks are then
joined to the documents they cover by their index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import running_start, ship, width
from granary.staging import stage

BLOCK_WORDS = 64
SHARD_BLOCKS = 4096

WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: dict, weights: tuple = (5, 2, 1), total_share: float = 1.5, cap: float = 2.0) -> dict:
    """Words to take of each source. Sources by code point, null last, weigh `weights`, repeating.

    They share total_share times all words by weight; a target stops at cap times its source's size and the
    excess is shared again by weight among the others, until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = total_share * sum(sizes.values())
    open_, target = list(names), {}
    while open_:
        spare = total - sum(target.values())
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if spare * weight[s] / whole > cap * sizes[s]]
        if not over:
            target |= {s: spare * weight[s] / whole for s in open_}
            break
        target |= {s: cap * float(sizes[s]) for s in over}
        open_ = [s for s in open_ if s not in target]
    return target


def shard_counts(quotas: np.ndarray, n_shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source in a shard, and those in the shards before it."""
    low, high, here, before = 0, n_shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = np.random.default_rng([seed, low, high]).binomial(here, (middle - low) / (high - low))
        if shard < middle:
            high, here = middle, left
        else:
            low, here, before = middle, here - left, before + left
    return here, before


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1, by a Feistel network with cycle walking."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def rounds(x):
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            mixed = (right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = rounds(index.astype(np.uint64))
    while (wide := out >= np.uint64(n)).any():
        out[wide] = rounds(out[wide])
    return out.astype(np.int64)


def mix(
    docs: DataFrame,
    weights: tuple = (5, 2, 1),
    total_share: float = 1.5,
    cap: float = 2.0,
    block_words: int = BLOCK_WORDS,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(per document, drawn blocks).

    Per document: (doc_id, row, source, size, source_size, target); null and empty texts have size 0 and take 0.
    Documents with the same id and source lie one behind the other; they count as one document each and are told apart by
    `row`, a number of each row: that of row_col, or else one given here. Drawn: (doc_id, row, shard, epoch, block, low, high): words low .. high
    of a document that a shard takes. A block is drawn at most ceil(cap) times, once in each epoch. The number of
    sources is taken to be small (names and sizes of sources go through the driver), their sizes are not.
    """
    spark = docs.sparkSession
    ship(spark)
    sized = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.monotonically_increasing_id() if row_col is None else F.col(row_col)).alias("row"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    totals = {r["source"]: int(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    goal = targets(totals, weights, total_share, cap)
    names = sorted((s for s in totals if s is not None)) + [s for s in totals if s is None]
    blocks = np.array([-(-totals[s] // block_words) for s in names], np.int64)
    quotas = np.array(
        [
            min(round(goal[s] * b / totals[s]), int(cap * b)) if totals[s] else 0
            for s, b in zip(names, blocks.tolist())
        ],
        np.int64,
    )
    n_shards = max(1, -(-int(quotas.sum()) // SHARD_BLOCKS))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                here, before = shard_counts(quotas, n_shards, shard, seed)
                number = np.repeat(np.arange(len(names)), here)
                slot = np.concatenate([np.arange(b, b + n) for b, n in zip(before, here)]) if len(names) else number
                epoch, block = slot // np.maximum(blocks[number], 1), np.zeros(len(slot), np.int64)
                for s in np.unique(number).tolist():
                    for e in np.unique(epoch[number == s]).tolist():
                        mine = (number == s) & (epoch == e)
                        block[mine] = permute(slot[mine] % blocks[s], int(blocks[s]), seed + 1000 * s + e)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(slot), shard), pa.int64()), pa.array(number, pa.int32()),
                        pa.array(epoch, pa.int32()), pa.array(block, pa.int64()),
                    ],
                    ["shard", "number", "epoch", "block"],
                )

    # Shards are rows of their own; a task holds one shard's blocks.
    draws = spark.range(n_shards, numPartitions=min(n_shards, width(spark))).mapInArrow(
        drawn, "shard long, number int, epoch int, block long"
    )
    numbers = spark.createDataFrame(
        [(i, s, totals[s], float(goal[s])) for i, s in enumerate(names)],
        "number int, name string, source_size long, target double",
    )
    known = sized.join(numbers, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    placed = stage(running_start(known, ["number"], ["doc_id", "row"], "size", "begin"), "placed")
    # A document lies in the blocks from its first word's to its last word's.
    cover = placed.where("size > 0").select(
        "doc_id", "row", "number", "begin", "size",
        F.explode(F.expr(f"sequence(begin div {block_words}, (begin + size - 1) div {block_words})")).alias("block"),
    )
    # Draws grow with the words, which their plan's estimate does not show: never broadcast them. A key has a
    # row per epoch at most, and a row per document that the block touches.
    taken = cover.join(draws.hint("merge"), ["number", "block"]).select(
        "doc_id", "row", "shard", "epoch", "block",
        F.expr(f"greatest(block * {block_words} - begin, 0L)").alias("low"),
        F.expr(f"least((block + 1) * {block_words} - begin, size)").alias("high"),
    )
    return placed.drop("number", "begin"), taken


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """Per document (doc_id, size, source_size, target, taken): the words a mix takes of it. Rows that share an id, or have
    none, each have what is taken of them alone."""
    per_doc, drawn = mix(docs, **options)
    words = drawn.groupBy("row").agg(F.sum(F.expr("high - low")).alias("taken"))
    return (
        per_doc.join(words, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def materialize(docs: DataFrame, drawn: DataFrame, row_col: str | None = None) -> DataFrame:
    """Documents as the mix takes them: one row per document and epoch it is drawn in, with
    the drawn words' stretches of text joined by a space, and n_chars counted anew. Columns as in `docs`.

    row_col: the column of `docs` that mix() was given to tell rows apart. Without it rows are found by doc_id, which must then be
    unique among the documents; see `mixed`.
    """
    from granary.llm.text import words

    ship(docs.sparkSession)
    key, drawn_key = ("doc_id", "doc_id") if row_col is None else (row_col, "row")
    parts = drawn.groupBy(drawn_key, "epoch").agg(
        F.array_sort(F.collect_list(F.struct("low", "high"))).alias("_parts")
    )
    joined = docs.join(
        parts.select(F.col(drawn_key).alias("_id"), "_parts"), F.col(key).eqNullSafe(F.col("_id"))
    ).drop("_id")
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("text")
            out = []
            for text, parts in zip(batch.column(at), batch.column(len(columns)).to_pylist()):
                raw = text.as_py().encode()
                found = words(pa.array([text.as_py()]))
                spans: list[list[int]] = []
                for part in parts:
                    if spans and spans[-1][1] == part["low"]:
                        spans[-1][1] = part["high"]
                    else:
                        spans.append([part["low"], part["high"]])
                whole = spans == [[0, len(found.starts)]]
                pieces = [raw[found.starts[a]: found.ends[z - 1]] for a, z in spans]
                out.append(text.as_py() if whole else b" ".join(pieces).decode())
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(out, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    kept = joined.mapInArrow(cut, docs.schema)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Documents as a mix takes them (see `materialize`). Ids may repeat or be null: each row is numbered, written with its
    number, and has its own stretches alone."""
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    _, drawn = mix(rows, row_col="_row", **options)
    return materialize(rows, drawn, row_col="_row").drop("_row")
