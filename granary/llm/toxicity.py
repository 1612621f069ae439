"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's probability is a logistic function of its words; a document's is the noisy-or of
its sentences', 1 - prod(1 - p). Training sees document labels alone and moves the blame to the sentences that
toxic documents share and others lack, so a trained model also locates the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from granary.llm.common import ship
from granary.llm.text import LETTERS_ONLY, buffers, slices, words

#: Labelled documents the model is fitted on at most, chosen by a hash of their id.
SAMPLE_DOCUMENTS = 6000
MIN_DOCUMENTS = 5
#: Words enter if the chi-square of their presence against the document label is at least this.
ASSOCIATION = 20.0
EPOCHS = 120
RATE = 0.15
DECAY = 2e-4

_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?\n\r"]] = True


@dataclass
class Model:
    """Bias and word weights, by word hash. An empty vocabulary scores by the bias alone."""

    bias: float
    hashes: np.ndarray
    weights: np.ndarray


@dataclass
class Sentences:
    """Words by sentence: word i belongs to sentence owner[i]; sentence s to text[s], at bytes low[s] .. high[s]."""

    hashes: np.ndarray
    owner: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray


def sentences(texts: pa.Array) -> Sentences:
    """Sentences of a slice of texts; they end at . ! ? and line ends. Those without letters or digits don't count."""
    found = words(texts, LETTERS_ONLY)
    n = len(found.hashes)
    if not n:
        none = np.zeros(0, np.int64)
        return Sentences(found.hashes, none, none, none, none)
    raw, offsets = buffers(texts)
    ends = np.flatnonzero(_SENTENCE_END[raw[offsets[0]: offsets[-1]]])
    text = np.repeat(np.arange(len(texts)), np.diff(found.first))
    number = np.searchsorted(ends, found.starts + (offsets - offsets[0])[text])
    new = np.ones(n, bool)
    new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], n) - 1
    return Sentences(found.hashes, np.cumsum(new) - 1, text[begins], found.starts[begins], found.ends[last])


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sentence_logits(model: Model, found: Sentences) -> np.ndarray:
    z = np.full(len(found.text), model.bias)
    if len(model.hashes) and len(found.hashes):
        at = np.minimum(np.searchsorted(model.hashes, found.hashes), len(model.hashes) - 1)
        weight = np.where(model.hashes[at] == found.hashes, model.weights[at], 0.0)
        z += np.bincount(found.owner, weight, len(z))
    return z


def document_scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Noisy-or of each text's sentences; 0 for a text without any."""
    out = np.zeros(len(texts))
    for a, z in slices(texts):
        found = sentences(texts[a:z])
        total = np.bincount(found.text, _softplus(_sentence_logits(model, found)), z - a)
        out[a:z] = -np.expm1(-total)
    return out


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 3) -> Model:
    """Fit by full-batch Adam on the noisy-or likelihood, with weight decay.

    The vocabulary holds the words of at least MIN_DOCUMENTS documents whose presence goes with the label. With labels of one kind only, or none,
    the model is a constant: 0 without a toxic document, else near 1 for texts with a sentence.
    """
    toxic = toxic.astype(bool)
    if not len(toxic) or not toxic.any() or toxic.all():
        return Model(20.0 if len(toxic) and toxic.all() else -40.0, np.zeros(0, np.uint64), np.zeros(0))
    hashes, owners, text_of, n_sentences = [], [], [], 0
    for a, z in slices(texts):
        found = sentences(texts[a:z])
        hashes.append(found.hashes)
        owners.append(found.owner + n_sentences)
        text_of.append(found.text + a)
        n_sentences += len(found.text)
    word, owner, text = (np.concatenate(x) for x in (hashes, owners, text_of))
    # A word counts once in a sentence, and once in a document for the vocabulary.
    vocabulary, index = np.unique(word, return_inverse=True)
    pairs = np.unique(index.astype(np.int64) * len(toxic) + text[owner])
    holds = np.bincount(pairs // len(toxic), minlength=len(vocabulary)).astype(float)
    among_toxic = np.bincount(pairs // len(toxic), toxic[pairs % len(toxic)].astype(float), len(vocabulary))
    n, share = len(toxic), toxic.mean()
    spread = np.maximum(holds * share * (1 - share) * (n - holds) / n, 1e-9)
    frequent = (holds >= MIN_DOCUMENTS) & ((among_toxic - holds * share) ** 2 / spread >= ASSOCIATION)
    place = np.cumsum(frequent) - 1
    kept = frequent[index]
    cells = np.unique(owner[kept].astype(np.int64) * max(1, int(frequent.sum())) + place[index[kept]])
    size = int(frequent.sum())
    owner, index = cells // max(1, size), cells % max(1, size)
    weights, bias = np.zeros(size), -6.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    y = toxic
    for step in range(1, EPOCHS + 1):
        z = bias + np.bincount(owner, weights[index], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        total = np.maximum(np.bincount(text, _softplus(z), len(y)), 1e-12)
        # d loss / d softplus(z): 1 for a clean document, -exp(-total) / (1 - exp(-total)) for a toxic one.
        outer = np.where(y, -1 / np.expm1(np.minimum(total, 50.0)), 1.0)
        slope = outer[text] * p / len(y)
        gradient = np.append(np.bincount(index, slope[owner], size) + DECAY * weights / max(1, size) ** 0.5, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    used = np.abs(weights) > 0.02
    names = vocabulary[frequent][used]
    order = np.argsort(names)
    return Model(float(bias), names[order], weights[used][order])


def is_held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model fitted on at most `sample` labelled documents that aren't held out.

    Labels or ids that are null, or labels other than 0 and 1, don't count; of repeated labels the larger does. The sample is bounded, so
    one task trains on it, and its ids may be broadcast. Without usable labels the model scores 0.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
        .where(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1) & ~F.coalesce(is_held_out("_id"), F.lit(True)))
        .groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")
    ).select("_doc", "_text", "_toxic")

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            table = table.sort_by([("_doc", "ascending"), ("_text", "ascending")])
        texts = table["_text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
        toxic = table["_toxic"].to_numpy() if table.num_rows else np.zeros(0, bool)
        model = train(texts, toxic)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(model.hashes.view(np.int64), 0)),
                pa.array(np.append(model.weights, model.bias)),
                pa.array(np.append(np.zeros(len(model.hashes), bool), True)),
            ],
            ["hash", "weight", "is_bias"],
        )

    if not rows.head(1):
        return Model(-40.0, np.zeros(0, np.uint64), np.zeros(0))
    # A shuffle of the sample alone: coalesce would scan all documents in the one task that trains.
    found = rows.repartition(1).mapInArrow(trained, "hash long, weight double, is_bias boolean").collect()
    bias = next(r["weight"] for r in found if r["is_bias"])
    pairs = sorted((r["hash"] % (1 << 64), r["weight"]) for r in found if not r["is_bias"])
    return Model(bias, np.array([h for h, _ in pairs], np.uint64), np.array([w for _, w in pairs]))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` plus `score_col`: how likely each text is toxic, 0 to 1. Null and empty texts score 0. No shuffle."""
    if score_col in docs.columns:
        raise ValueError(f"column {score_col} is taken")
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = document_scores(model, batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, score_col]
            )

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def locate(
    docs: DataFrame, model: Model, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Offending sentences: (doc_id, low, high, sentence, probability), those of at least `least`.

    low and high count UTF-8 bytes. Documents without such a sentence have no row.
    """
    ship(docs.sparkSession)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out = []
            for a, z in slices(texts):
                found = sentences(texts[a:z])
                p = 1 / (1 + np.exp(-np.clip(_sentence_logits(model, found), -40, 40)))
                for s in np.flatnonzero(p >= least).tolist():
                    i = a + int(found.text[s])
                    low, high = int(found.low[s]), int(found.high[s])
                    out.append((ids[i], low, high, texts[i].as_py().encode()[low:high].decode(), float(p[s])))
            columns = list(zip(*out)) or [()] * 5
            kinds = (batch.column(0).type, pa.int64(), pa.int64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "low", "high", "sentence", "probability"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        located, f"doc_id {kind}, low long, high long, sentence string, probability double"
    )


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, by a model of the labels that aren't held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
