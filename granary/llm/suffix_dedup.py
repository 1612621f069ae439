"""Repeated passages by windows at shared positions.

Positions are content-selected: the minimisers of hashes of GRAM words over windows of such
hashes, so wide that any passage of `least_words` words holds one, the same in every document it is in.
Around positions whose GRAM words occur in several documents, every window of `least_words` words that holds them is hashed. Windows
with equal hashes in several documents are repeated, whatever stands beside them; those of a document that overlap are united.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ship, width
from granary.llm.spans import first_of_copies, merged, per_text, sequence_print
from granary.llm.text import gram_hashes, mix, signed, slices, words
from granary.staging import stage

GRAM = 25


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the smallest of some `window` neighbouring hashes; all of equal ones."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    lows = np.lib.stride_tricks.sliding_window_view(grams, window).min(1)
    # The largest minimum of the windows that hold a position equals its own hash only if it is one.
    padded = np.concatenate((np.zeros(window - 1, grams.dtype), lows, np.zeros(window - 1, grams.dtype)))
    highest = np.lib.stride_tricks.sliding_window_view(padded, window).max(1)
    return np.flatnonzero(highest == grams)


def _around(at: list[int], n_words: int, gram: int, least_words: int) -> np.ndarray:
    """Begins of the windows of `least_words` words that hold the gram at one of the positions."""
    begins = np.unique(np.asarray(at, np.int64)[:, None] - np.arange(least_words - gram + 1))
    return begins[(begins >= 0) & (begins <= n_words - least_words)]


def _united(least_words: int):
    """Runs of windows that overlap, of rows (doc_id, at, other) in order; other is the smallest of a run's."""

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = None
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, at, other = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            fresh = np.append(True, (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + least_words))
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(at)) - 1
            runs = list(zip(
                doc[first].tolist(), at[first].tolist(), (at[last] + least_words).tolist(),
                np.minimum.reduceat(other, first).tolist(),
            ))
            if run is not None:
                if run[0] == runs[0][0] and runs[0][1] <= run[2]:
                    runs[0] = (run[0], run[1], max(run[2], runs[0][2]), min(run[3], runs[0][3]))
                else:
                    runs.insert(0, run)
            run = runs.pop()
            yield _spans(runs)
        yield _spans([] if run is None else [run])

    return united


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "low", "high", "other"])


def repeated_passages(
    docs: DataFrame,
    least_words: int = 50,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, low, high, n_words, first_doc_id): stretches of words low .. high of a document of which
    passages of `least_words` words or more stand in other documents too.

    Words are lower-cased in A-Z. first_doc_id is the smallest document found to share it, itself included. Copies of a whole text
    of at least that length are one row each; beyond that, passages within one document don't count. Null and empty texts and null
    ids have no passages; rows that share an id are taken as one document with several texts. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    window = least_words - gram + 1
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, keys, places = [], [], [], []
            for a, z in slices(batch.column(1)):
                for hashes in per_text(words(batch.column(1)[a:z])):
                    grams = gram_hashes(hashes, gram)
                    at = minimisers(grams, window)
                    sizes.append(len(hashes))
                    prints.append(sequence_print(hashes))
                    keys.append(signed(grams[at]))
                    places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_words", "f1", "f2", "keys", "places"],
            )

    marks = stage(
        own.mapInArrow(marked, "doc_id long, n_words long, f1 long, f2 long, keys array<long>, places array<int>"), "marks"
    )
    classes = first_of_copies(marks, least_words)
    known = marks.where(f"n_words >= {least_words}").join(classes, ["f1", "f2"])
    known = stage(known.where("rows > 1 or rep = doc_id"), "known")
    positions = known.where("rep = doc_id").select("doc_id", F.explode(F.arrays_zip("keys", "places")).alias("p")).select(
        F.col("p.keys").alias("key"), "doc_id", F.col("p.places").alias("at")
    )
    shared = positions.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("key")
    wanted = positions.join(shared, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "at")).alias("_wanted"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, wanted in enumerate(batch.column(2).to_pylist()):
                hashes = words(batch.column(1).slice(i, 1)).hashes
                grams = gram_hashes(hashes, gram)
                own_keys = signed(grams)
                at = [w["at"] for w in wanted if w["at"] < len(grams) and own_keys[w["at"]] == w["key"]]
                begins = _around(at, len(hashes), gram, least_words)
                full = gram_hashes(hashes, least_words)[begins] if len(begins) else np.zeros(0, np.uint64)
                # 32 bits more, of the window's first and last gram.
                more = mix(mix(grams[begins]) + grams[begins + window - 1]) >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(full)), pa.array(more.astype(np.uint32).view(np.int32)),
                        batch.column(0).take(pa.array(np.full(len(begins), i))), pa.array(begins.astype(np.int32)),
                    ],
                    ["key", "more", "doc_id", "at"],
                )

    held = stage(
        own.join(wanted.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_wanted")
        .mapInArrow(windows, "key long, more int, doc_id long, at int"),
        "windows",
    )
    repeated = (
        held.groupBy("key", "more").agg(F.min("doc_id").alias("other"), F.max("doc_id").alias("hi"))
        .where("other <> hi").drop("hi")
    )
    spans = (
        held.join(repeated, ["key", "more"]).select("doc_id", "at", "other")
        .repartition(width(spark), "doc_id").sortWithinPartitions("doc_id", "at")
        .mapInArrow(_united(least_words), "doc_id long, low long, high long, other long")
    )
    whole = known.where("rows > 1").select(
        "doc_id", F.lit(0).cast("long").alias("low"), F.col("n_words").alias("high"), F.col("rep").alias("other")
    )
    return merged(spans.unionByName(whole)).select(
        "doc_id", "low", "high", (F.col("high") - F.col("low")).alias("n_words"), F.least("doc_id", "other").alias("first_doc_id")
    )
