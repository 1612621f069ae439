"""Token ids as length-limited canonical Huffman codes, in blocks that decode by themselves.

A written folder holds two Parquet tables. `codes` has the code length of each id that occurs:
canonical codes follow from the lengths alone. `blocks` has one row per block of whole
documents, in ascending document order over (part, block): the documents' ids and token
numbers, the code bits, and the bit offset of every CHECK_EVERY-th token. All checkpoints
of a block are decoded side by side from one lookup table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import running_start, ship, width
from granary.llm.tokens import public_path, word_tokenizer
from granary.staging import stage

BLOCK_TOKENS = 1 << 18
CHECK_EVERY = 256
MAX_BITS = 18


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 where a count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    n = len(order)
    # Each level merges the leaves with the pairs of the level below; leaf_ranks keeps
    # which places of a level are leaves.
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        weights = np.concatenate((leaves, packages))
        merged = np.argsort(weights, kind="stable")
        levels.append(merged < n)
        ordered = weights[merged]
        even = len(ordered) // 2 * 2
        packages = ordered[0:even:2] + ordered[1:even:2]
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for is_leaf in reversed(levels):
        leaf_count = int(is_leaf[:take].sum())
        depth[:leaf_count] += 1
        take = 2 * (take - leaf_count)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each id: by length, then by id."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    codes = np.zeros(len(lengths), np.uint64)
    sizes = lengths[order]
    if len(order):
        top = int(sizes[-1])
        spans = np.uint64(1) << (top - sizes).astype(np.uint64)
        begins = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spans)[:-1].astype(np.uint64)))
        codes[order] = begins >> (top - sizes).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and length for each value of the next `bits` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    bits = int(lengths.max(initial=1))
    spans = 1 << (bits - lengths[order])
    ids, sizes = np.repeat(order, spans), np.repeat(lengths[order], spans)
    short = (1 << bits) - len(ids)
    return np.pad(ids, (0, short)), np.pad(sizes, (0, short), constant_values=1), bits


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Code bits of the ids, and the bit offset of each checkpoint."""
    sizes = lengths[ids]
    if len(ids) and not sizes.all():
        raise ValueError("an id without a code")
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    total, offsets = int(offsets[-1]), offsets[:-1]
    shift = (64 - sizes - (offsets & 31)).astype(np.uint64)
    placed = codes[ids] << shift
    word = offsets >> 5
    n = (total + 31) // 32
    # Bits never overlap, so sums below 2^32 are exact in double precision.
    high = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), n + 1)
    low = np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)
    return (high + low)[:n].astype(">u4").tobytes(), offsets[::CHECK_EVERY]


def unpack_bits(
    bits: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]
) -> np.ndarray:
    """The n ids of a block; every checkpoint is a lane of its own."""
    ids, sizes, width_bits = table
    words = np.concatenate((np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64)))
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    lanes = len(checkpoints)
    out = np.zeros((lanes, CHECK_EVERY), np.uint32)
    at = checkpoints.astype(np.int64)
    last = len(pairs) - 1
    down = np.uint64(64 - width_bits)
    for step in range(min(CHECK_EVERY, n) if lanes == 1 else CHECK_EVERY):
        window = pairs[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64)
        value = (window >> down).astype(np.int64)
        out[:, step] = ids[value]
        at = at + sizes[value]
    return out.reshape(-1)[:n]


def _id_arrays(batch: pa.RecordBatch, tokenizer: str, end_id: int | None) -> Iterator[tuple[int, np.ndarray]]:
    library = word_tokenizer(public_path(tokenizer) if "/" not in tokenizer else tokenizer)
    end = np.array([] if end_id is None else [end_id], "<u4")
    for key, ids in zip(batch.column(0).to_pylist(), library.encode_all(batch.column(1))):
        yield key, np.concatenate((ids, end))


def _arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Ids of a batch of (n_tokens, ids, ...): two bytes each, or four."""
    for n, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
        data = raw.as_py()
        yield np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def write_encoded(
    docs: DataFrame,
    path: str,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Tokenize all texts and write their ids below `path`.

    Texts are dealt into ranges of document ids first, tokenized there, and kept as ids for
    the two passes that count and encode. Null texts are empty; they still have the end id, if
    one is given. Null document ids come first; equal ids follow each other in any order.
    Empty tables make empty files. Columns beside id and text are not read.
    """
    spark = docs.sparkSession
    ship(spark)

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, packed = [], [], []
            for key, ids in _id_arrays(batch, tokenizer, end_id):
                keys.append(key)
                sizes.append(len(ids))
                packed.append(ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65536 else ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )

    tokens = stage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(width(spark), "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(tokenized, "doc_id long, n_tokens long, ids binary"),
        "token-ids",
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in _arrays(batch):
                if len(ids):
                    part = np.bincount(ids, minlength=len(total))
                    part[: len(total)] += total
                    total = part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    # At most one row per vocabulary entry comes to the driver.
    counts = (
        tokens.select("n_tokens", "ids").mapInArrow(counted, "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")).collect()
    )
    frequency = np.zeros(max([row["id"] + 1 for row in counts], default=0), np.int64)
    for row in counts:
        frequency[row["id"]] = row["n"]
    lengths = code_lengths(frequency)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int"
    ).coalesce(1).write.parquet(f"{path}/codes")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        keys, held, size = [], [], 0

        def block() -> pa.RecordBatch:
            bits, checks = pack_bits(np.concatenate(held), lengths, codes)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                    pa.array([checks], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()),
                ],
                ["doc_ids", "n_tokens", "checkpoints", "bits"],
            )

        for batch in batches:
            for key, ids in zip(batch.column(2).to_pylist(), _arrays(batch)):
                # A task may read several pieces of the range partitions, in any order.
                falls = bool(keys) and keys[-1] is not None and (key is None or key < keys[-1])
                if held and (size + len(ids) > BLOCK_TOKENS or falls):
                    yield block()
                    keys, held, size = [], [], 0
                keys.append(key)
                held.append(ids)
                size += len(ids)
        if held:
            yield block()

    (
        tokens.select("n_tokens", "ids", "doc_id")
        .mapInArrow(encoded, "doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, bits binary")
        .withColumn("block", F.monotonically_increasing_id())
        .write.parquet(f"{path}/blocks")
    )


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder: (doc_id, block, place, n_tokens, ids).

    ids: little-endian unsigned 32-bit integers. Blocks decode independently of each other.
    """
    ship(spark)
    rows = spark.read.schema("id long, bits int").parquet(f"{path}/codes").collect()
    lengths = np.zeros(max([r["id"] + 1 for r in rows], default=0), np.int64)
    for r in rows:
        lengths[r["id"]] = r["bits"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            for block, keys, sizes, checks, bits in zip(*(batch.column(i) for i in range(5))):
                sizes = np.array(sizes.as_py(), np.int64)
                ids = unpack_bits(bits.as_py(), np.array(checks.as_py(), np.int64), int(sizes.sum()), table).astype("<u4")
                ends = np.cumsum(sizes).tolist()
                begins = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.as_py(), pa.int64()),
                        pa.array([block.as_py()] * len(ends), pa.int64()),
                        pa.array(range(len(ends)), pa.int32()),
                        pa.array(sizes, pa.int64()),
                        pa.array([ids[a:z].tobytes() for a, z in zip(begins, ends)], pa.binary()),
                    ],
                    ["doc_id", "block", "place", "n_tokens", "ids"],
                )

    return (
        spark.read.schema(
            "block long, doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, bits binary"
        )
        .parquet(f"{path}/blocks")
        .mapInArrow(decoded, "doc_id long, block long, place int, n_tokens long, ids binary")
    )


def encoded_summary(spark: SparkSession, path: str) -> DataFrame:
    """Read a written folder back: (doc_id, start, n_tokens, ids_crc32).

    start: ids of all documents before it in ascending doc_id order.
    """
    read = read_encoded(spark, path).select(
        "doc_id", "block", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    rows = running_start(stage(read, "decoded"), [], ["doc_id", "block", "place"], "n_tokens", "start")
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")
