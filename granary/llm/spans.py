"""Spans of words: whole copies, merging, cutting out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import ship
from granary.llm.text import Words, mix, signed, words

_U = np.uint64


def sequence_print(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a sequence of word hashes."""
    if not len(hashes):
        return 0, 0
    place = mix(np.arange(1, len(hashes) + 1, dtype=_U))
    pair = np.array([mix(hashes ^ place).sum(), mix(hashes + place).sum()], _U)
    return tuple(signed(pair).tolist())


def per_text(found: Words) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    for a, z in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        yield found.hashes[a:z]


def first_of_copies(marks: DataFrame, least_words: int) -> DataFrame:
    """(f1, f2, rep, rows) of each different sequence of at least `least_words` words; rep is its smallest document."""
    return (
        marks.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
        .groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    )


def merged(spans: DataFrame) -> DataFrame:
    """(doc_id, low, high, other) with overlapping and touching spans of a document united; other is the smallest of theirs."""
    before = Window.partitionBy("doc_id").orderBy("low", "high", "other").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id").orderBy("low", "high", "other").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce(F.col("low") > F.max("high").over(before), F.lit(True)).cast("int")
    return (
        spans.distinct().withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(upto))
        .groupBy("doc_id", "_island").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("other").alias("other"))
        .drop("_island")
    )


def cut_out(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` without the words of their spans (doc_id, low, high); documents left without a word go.

    What is left keeps its own white space; the parts are joined by a line end. n_chars is counted anew for cut documents.
    """
    ship(docs.sparkSession)
    listed = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("_spans"))
    joined = docs.join(listed.select(F.col("doc_id").alias("_id"), "_spans"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = columns.index("text")
            texts, out, keep = batch.column(at), [], []
            for i, spans in enumerate(batch.column(len(columns)).to_pylist()):
                text = texts[i].as_py()
                if spans is None or text is None:
                    out.append(text)
                    keep.append(True)
                    continue
                raw, found = text.encode(), words(pa.array([text]))
                n, parts, word = len(found.starts), [], 0
                for span in [*spans, {"low": n, "high": n}]:
                    if span["low"] > word:
                        parts.append(raw[found.starts[word]: found.ends[min(span["low"], n) - 1]])
                    word = max(word, span["high"])
                out.append(b"\n".join(parts).decode())
                keep.append(bool(parts))
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(out, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, columns).filter(pa.array(keep, pa.bool_()))

    kept = joined.mapInArrow(cut, docs.schema)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
