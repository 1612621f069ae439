"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its score is linear in features of its own, the line before and the line after; neighbouring labels
are tied by a weight for good-good and one for bad-bad. Training sees document labels alone: a good document has good
lines only, a bad one has at least one bad line, and the likelihood of just that is maximised. A document's
quality is the mean of its lines' forward-backward marginals, weighted by length, on a scale fitted to the labels.

Lines end at line feeds; those without a word don't count. All lines of all texts are labelled, whatever their length.
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
from granary.llm.text import buffers, slices, words

#: Labelled documents the model is fitted on at most, chosen by a hash of their id.
SAMPLE_DOCUMENTS = 6000
#: Bytes of text of the sample at most; documents that pass it are left out of the fit, in the order of the hash.
SAMPLE_BYTES = 256 << 20
EPOCHS = 150
RATE = 0.1
DECAY = 1e-3

_U = np.uint64


def _class(codes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(codes)] = True
    return found


_UPPER = _class(range(ord("A"), ord("Z") + 1))
_LETTER = _class([*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)])
_DIGIT = _class(range(ord("0"), ord("9") + 1))
_STOP = _class(map(ord, ".,;:'\"()-?"))
_SPACE = _class([0x20, *range(0x09, 0x0E)])
_SIGN = ~(_LETTER | _DIGIT | _STOP | _SPACE)
_END = _class(map(ord, ".!?"))

#: Features of one line; a line also has those of the lines before and after it.
FEATURES = (
    "upper", "digit", "sign", "stop", "capital words", "words with signs", "bare words", "repeated", "distinct",
    "word length", "length", "ends well", "short",
)
N_FEATURES = 3 * len(FEATURES) + 3


@dataclass
class Lines:
    """Lines of some texts: text, bytes low .. high in it, and features; lines of text i are first[i] .. first[i + 1]."""

    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    features: np.ndarray
    first: np.ndarray


@dataclass
class Model:
    """Weights on standardised features, bias, ties of good and of bad neighbours, and the scale of the aggregate.

    Texts without a line score `prior`.
    """

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    good: float
    bad: float
    slope: float
    shift: float
    prior: float


def lines(texts: pa.Array) -> Lines:
    """Lines with a word of a slice of texts."""
    found = words(texts)
    n_words, n_texts = len(found.hashes), len(texts)
    if not n_words:
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, np.zeros((0, N_FEATURES)), np.zeros(n_texts + 1, np.int64))
    raw, offsets = buffers(texts)
    data, bounds = raw[offsets[0]: offsets[-1]], offsets - offsets[0]
    word_text = np.repeat(np.arange(n_texts), np.diff(found.first))
    begins, ends = found.starts + bounds[word_text], found.ends + bounds[word_text]
    number = np.searchsorted(np.flatnonzero(data == 0x0A), begins)
    new = np.ones(n_words, bool)
    new[1:] = (word_text[1:] != word_text[:-1]) | (number[1:] != number[:-1])
    heads = np.flatnonzero(new)
    owner = np.cumsum(new) - 1
    n = len(heads)
    text = word_text[heads]
    low, high = begins[heads], ends[np.append(heads[1:], n_words) - 1]
    size = (high - low).astype(float)
    n_of = np.diff(np.append(heads, n_words)).astype(float)

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(kind[data])))
        return (total[high] - total[low]) / size

    def per_word(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.int32), np.cumsum(kind[data], dtype=np.int32)))
        return total[ends] - total[begins]

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, n) / n_of

    letters, capitals, signs = per_word(_LETTER), per_word(_UPPER), per_word(_SIGN)
    same = np.zeros(n_words, bool)
    same[1:] = (found.hashes[1:] == found.hashes[:-1]) & ~new[1:]
    # Distinct words of a line count as a power of its words: long lines of prose repeat words too.
    order = np.lexsort((found.hashes, owner))
    sorted_hash, sorted_owner = found.hashes[order], owner[order]
    fresh = np.ones(n_words, bool)
    fresh[1:] = (sorted_hash[1:] != sorted_hash[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    distinct = np.bincount(sorted_owner[fresh], minlength=n)
    own = np.stack([
        share(_UPPER), share(_DIGIT), share(_SIGN), share(_STOP),
        mean((capitals > 1) & (capitals == letters)), mean(signs > 0), mean(letters == 0), mean(same),
        (1 + np.log(distinct)) / (1 + np.log(n_of)), np.log1p(mean((ends - begins).astype(float))), np.log1p(size),
        _END[data[high - 1]], n_of < 4,
    ], 1).astype(float)
    first = np.searchsorted(text, np.arange(n_texts + 1))
    starts = np.zeros(n, bool)
    starts[first[:-1][np.diff(first) > 0]] = True
    stops = np.append(starts[1:], True)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    after[:-1] = own[1:]
    before[starts], after[stops] = 0, 0
    content = np.zeros(n, _U)
    np.add.at(content, owner, found.hashes * (_U(2) * (np.arange(n_words) - heads[owner]).astype(_U) + _U(1)))
    copies = np.zeros(n, bool)
    copies[1:] = (content[1:] == content[:-1]) & ~starts[1:]
    features = np.concatenate((own, before, after, starts[:, None], stops[:, None], copies[:, None]), 1)
    return Lines(text, low - bounds[text], high - bounds[text], features, first)


class _Steps:
    """Positions of the k-th line of every text that has one, longest texts first."""

    def __init__(self, first: np.ndarray):
        sizes = np.diff(first)
        self.order = np.argsort(-sizes, kind="stable")
        self.order = self.order[sizes[self.order] > 0]
        self.sizes, self.first = sizes[self.order], first[:-1][self.order]
        longest = int(self.sizes[0]) if len(self.sizes) else 0
        ascending = self.sizes[::-1]
        self.active = len(self.sizes) - np.searchsorted(ascending, np.arange(longest), side="right")

    def __len__(self) -> int:
        return len(self.active)

    def at(self, k: int) -> np.ndarray:
        return self.first[: self.active[k]] + k


def chain(logits: np.ndarray, first: np.ndarray, good: float, bad: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of good for each line, log of the weight of all labellings for each text, and for
    each text the expected numbers of good-good and bad-bad neighbours.

    A labelling weighs the sum of its good lines' logits, `good` for each good-good and `bad` for each bad-bad pair.
    """
    steps = _Steps(first)
    n, k_max = len(logits), len(steps)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    for k in range(k_max):
        at = steps.at(k)
        if k:
            a = forward[at - 1]
            forward[at, 0] = np.logaddexp(a[:, 0] + bad, a[:, 1])
            forward[at, 1] = np.logaddexp(a[:, 0], a[:, 1] + good)
        forward[at, 1] += logits[at]
    for k in range(k_max - 1, 0, -1):
        at = steps.at(k)
        b0, b1 = backward[at, 0], backward[at, 1] + logits[at]
        backward[at - 1, 0] = np.logaddexp(b0 + bad, b1)
        backward[at - 1, 1] = np.logaddexp(b0, b1 + good)
    total = np.zeros(len(first) - 1)
    last = steps.first + steps.sizes - 1
    total[steps.order] = np.logaddexp(forward[last, 0], forward[last, 1])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    marginal = np.exp(forward[:, 1] + backward[:, 1] - total[text])
    inner = np.ones(n, bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    both = np.exp(forward[at - 1, 1] + good + logits[at] + backward[at, 1] - total[text[at]])
    none = np.exp(forward[at - 1, 0] + bad + backward[at, 0] - total[text[at]])
    pairs = np.stack([np.bincount(text[at], x, len(first) - 1) for x in (both, none)], 1)
    return np.minimum(marginal, 1.0), total, pairs


def loss_and_gradient(
    parameters: np.ndarray, features: np.ndarray, first: np.ndarray, good_document: np.ndarray
) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of document labels, and its slope. Parameters: weights, bias, good, bad."""
    weights, bias, good, bad = parameters[:-3], parameters[-3], parameters[-2], parameters[-1]
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    logits = features @ weights + bias
    marginal, total, pairs = chain(logits, first, good, bad)
    # Log-probability that all lines are good.
    clean = np.minimum(np.bincount(text, logits, len(n)) + good * np.maximum(n - 1, 0) - total, -1e-12)
    loss = np.where(good_document, -clean, -np.log(-np.expm1(clean))).mean()
    outer = np.where(good_document, -1.0, 1 / np.expm1(np.minimum(-clean, 500.0))) / len(n)
    slope = outer[text] * (1 - marginal)
    gradient = np.concatenate((
        features.T @ slope,
        [slope.sum(), (outer * (np.maximum(n - 1, 0) - pairs[:, 0])).sum(), -(outer * pairs[:, 1]).sum()],
    ))
    return float(loss), gradient


def _scaled(found: Lines, model: Model) -> np.ndarray:
    return np.clip((found.features - model.mean) / model.spread, -5, 5)


def line_marginals(model: Model, found: Lines) -> np.ndarray:
    return chain(_scaled(found, model) @ model.weights + model.bias, found.first, model.good, model.bad)[0]


def _quality(marginal: np.ndarray, found: Lines) -> np.ndarray:
    """Logit of the length-weighted mean of the marginals of each text; nan without lines."""
    size = (found.high - found.low).astype(float)
    n = len(found.first) - 1
    weight = np.bincount(found.text, size, n)
    mean = np.bincount(found.text, size * marginal, n) / np.where(weight > 0, weight, np.nan)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def document_scores(model: Model, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for a, z in slices(texts):
        found = lines(texts[a:z])
        q = _quality(line_marginals(model, found), found)
        value = 1 / (1 + np.exp(-np.clip(model.slope * q + model.shift, -40, 40)))
        out[a:z] = np.where(np.isnan(q), model.prior, value)
    return out


def constant(prior: float) -> Model:
    zero = np.zeros(N_FEATURES)
    return Model(zero, np.ones(N_FEATURES), zero, 0.0, 0.0, 0.0, 0.0, float(np.log(prior / (1 - prior))), prior)


def train(texts: pa.Array, good: np.ndarray) -> Model:
    """Fit by full-batch Adam. With labels of one kind only, or none, the score is a constant: their share, kept from 0 and 1."""
    good = good.astype(bool)
    prior = (float(good.sum()) + 1) / (len(good) + 2)
    if not len(good) or good.all() or not good.any():
        return constant(prior)
    parts = [lines(texts[a:z]) for a, z in slices(texts)]
    features = np.concatenate([p.features for p in parts])
    first = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(p.first) for p in parts]))))
    size = np.concatenate([p.high - p.low for p in parts])
    held = np.diff(first) > 0
    if not good[held].any() or good[held].all():
        return constant(prior)
    mean, spread = features.mean(0), features.std(0)
    model = constant(prior)
    model.mean, model.spread = mean, np.where(spread > 1e-9, spread, 1.0)
    text = np.repeat(np.arange(len(good)), np.diff(first))
    everything = Lines(text, np.zeros(len(size), np.int64), size, features, first)
    scaled = _scaled(everything, model)
    # Documents without lines have nothing to say.
    kept = np.concatenate(([0], first[1:][held]))
    parameters = np.concatenate((np.zeros(N_FEATURES), [2.0, 1.0, 1.0]))
    one, two = np.zeros_like(parameters), np.zeros_like(parameters)
    decay = np.concatenate((np.full(N_FEATURES, DECAY), np.zeros(3)))
    for step in range(1, EPOCHS + 1):
        _, gradient = loss_and_gradient(parameters, scaled, kept, good[held])
        gradient += decay * parameters
        one = 0.9 * one + 0.1 * gradient
        two = 0.999 * two + 0.001 * gradient**2
        parameters = parameters - RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-9)
    model.weights, model.bias, model.good, model.bad = parameters[:-3], *(float(x) for x in parameters[-3:])
    q = _quality(line_marginals(model, everything), everything)[held]
    # Scale by Newton steps of a logistic fit of the labels on the aggregate, lightly held to small values.
    design, scale, y = np.stack([q, np.ones_like(q)], 1), np.zeros(2), good[held]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ scale, -40, 40)))
        slope = design.T @ (p - y) + 0.1 * scale
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        scale = scale - np.linalg.solve(bend, slope)
    model.slope, model.shift = max(float(scale[0]), 1e-3), float(scale[1])
    return model


def is_held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def _flat(model: Model) -> np.ndarray:
    rest = [model.bias, model.good, model.bad, model.slope, model.shift, model.prior]
    return np.concatenate((model.mean, model.spread, model.weights, rest))


def _model(values: np.ndarray) -> Model:
    n = N_FEATURES
    return Model(values[:n], values[n: 2 * n], values[2 * n: 3 * n], *(float(x) for x in values[3 * n:]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """A model fitted on at most `sample` labelled documents, of SAMPLE_BYTES together, that aren't held out.

    Labels or ids that are null, or labels other than 0 and 1, don't count; of repeated labels the smaller does. The sample is bounded, so
    one task trains on it, and its ids may be broadcast. Without usable labels every score is one half.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_good"))
        .where(F.col("_id").isNotNull() & F.col("_good").isin(0, 1) & ~F.coalesce(is_held_out("_id"), F.lit(True)))
        .groupBy("_id").agg(F.min("_good").alias("_good"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")
    ).select(F.xxhash64("_id").alias("_hash"), "_doc", "_text", "_good")

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, size = [], 0
        for batch in batches:
            sizes = np.diff(buffers(batch.column(2))[1])
            fits = size + np.cumsum(sizes) <= SAMPLE_BYTES
            size += int(sizes[fits].sum())
            taken.append(batch.filter(pa.array(fits)))
        table = pa.Table.from_batches(taken) if taken else None
        if table is None or not table.num_rows:
            model = constant(0.5)
        else:
            model = train(table["_text"].combine_chunks(), table["_good"].to_numpy())
        values = _flat(model)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    # Only the sample is shuffled to the task that trains; its order is the same in every run.
    ordered = rows.repartition(1).sortWithinPartitions("_hash", "_doc", "_text")
    found = sorted(ordered.mapInArrow(trained, "at long, value double").collect())
    return _model(np.array([r["value"] for r in found])) if found else constant(0.5)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` plus `score_col`: how likely each text is good, 0 to 1. Texts without a line get the model's prior. No shuffle."""
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


def label_lines(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line with a word: (doc_id, low, high, good), its UTF-8 bytes and the probability that it is good."""
    ship(docs.sparkSession)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, z in slices(texts):
                found = lines(texts[a:z])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found.text + a)), pa.array(found.low), pa.array(found.high), pa.array(line_marginals(model, found))],
                    ["doc_id", "low", "high", "good"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(labelled, f"doc_id {kind}, low long, high long, good double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, by a model of the labels that aren't held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
