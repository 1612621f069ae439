"""Embedding near-duplicates by randomly rotated binary codes with correction factors.

A unit vector o is rotated and kept as the signs of its components, c = sign(Po) / sqrt(D), with the factor
a = <c, Po>. For another unit vector q, s = <c, Pq> / a is an unbiased estimate of <o, q> over the random rotation,
and its error is at most sqrt(1 - a^2) / a * epsilon / sqrt(D - 1) but for a chance that falls as exp(-epsilon^2 / 2). Pq's part
outside c can't add more than sqrt(1 - a^2) * sqrt(1 - t^2) either when <o, q> = t, which needs no chance at all. A pair whose
upper bound stays below the threshold is dropped; all others are computed again in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import components, spread
from granary.llm.vectors import matrix, vector_bytes
from granary.staging import stage

TILE = 16384
ROWS_AT_ONCE = 512
#: Pairs computed again in double precision at once.
PAIRS_AT_ONCE = 1 << 15


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits (packed), correction factors and rotated vectors of unit vectors."""
    turned = unit @ rotation(unit.shape[1])
    signs = turned >= 0
    factor = np.abs(turned).sum(1) / math.sqrt(unit.shape[1])
    return np.packbits(signs, axis=1), factor, turned


def lowest_estimate(factor: np.ndarray, dim: int, threshold: float, epsilon: float) -> np.ndarray:
    """Pairs with <c, Pq> below this can't reach the threshold (see the module)."""
    away = np.sqrt(np.maximum(0, 1 - factor**2))
    reach = min(epsilon / math.sqrt(max(1, dim - 1)), math.sqrt(max(0.0, 1 - threshold**2)))
    if threshold < 0:
        reach = 1.0
    return threshold * factor - away * reach - 1e-5


class _Forest:
    """Which rows are already connected; labels are kept flat."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, row: int, others: np.ndarray) -> list[tuple[int, int]]:
        labels = np.unique(np.append(self.label[others], self.label[row]))
        if len(labels) == 1:
            return []
        self.label[np.isin(self.label, labels[1:])] = labels[0]
        return [(int(labels[0]), int(x)) for x in labels[1:]]


def compare_tile(
    left: pd.DataFrame, right: pd.DataFrame | None, threshold: float, epsilon: float
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], int]:
    """Links between the rows of two frames (rep, copies, vec), or within one if right is None.

    Returns reps, their numbers of linked vectors (copies counted), pairs that connect what
    is linked (fewer than there are rows), and how many pairs were computed exactly.
    """
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    exact = matrix(both["vec"].tolist(), "<f8")
    norms = np.sqrt((exact * exact).sum(1))
    # Squares of very small or large components leave the range of doubles; a power of two brings them back exactly.
    odd = ~((norms > 1e-140) & (norms < 1e140))
    if odd.any():
        exact = exact.copy()
        exact[odd] = np.ldexp(exact[odd], -np.frexp(np.abs(exact[odd]).max(1))[1][:, None])
        norms = np.sqrt((exact * exact).sum(1))
    codes, factor, turned = encode(exact / norms[:, None])
    dim, n, split = exact.shape[1], len(both), len(left)
    signs = (np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
    turned = turned.astype(np.float32)
    lowest = lowest_estimate(factor, dim, threshold, epsilon).astype(np.float32)
    copies = both["copies"].to_numpy(np.int64)
    links, forest, edges, computed = np.zeros(n, np.int64), _Forest(n), [], 0
    begin = split if right is not None else 0
    for at in range(0, split, ROWS_AT_ONCE):
        to = min(split, at + ROWS_AT_ONCE)
        first = begin if right is not None else at
        candidate = signs[at:to] @ turned[first:].T >= lowest[at:to, None]
        if right is None:
            candidate &= np.arange(first, n)[None, :] > np.arange(at, to)[:, None]
        place = np.flatnonzero(candidate)
        rows, others = at + place // candidate.shape[1], first + place % candidate.shape[1]
        computed += len(rows)
        linked = np.zeros(len(rows), bool)
        for a in range(0, len(rows), PAIRS_AT_ONCE):
            i, j = rows[a: a + PAIRS_AT_ONCE], others[a: a + PAIRS_AT_ONCE]
            linked[a: a + PAIRS_AT_ONCE] = (exact[j] * exact[i]).sum(1) / (norms[j] * norms[i]) >= threshold
        rows, others = rows[linked], others[linked]
        np.add.at(links, rows, copies[others])
        np.add.at(links, others, copies[rows])
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for own, near in zip(rows[np.append(0, cuts)] if len(rows) else (), np.split(others, cuts)):
            edges += forest.join(int(own), near)
    reps = both["rep"].to_numpy(np.int64)
    return reps, links, [(int(reps[a]), int(reps[b])) for a, b in edges], computed


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.9,
    epsilon: float = 4.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tile: int = TILE,
) -> DataFrame:
    """Links between vectors with cosine >= threshold: (vec_id, n_links, component_id, kept).

    Equal vectors are one row with a number of copies; tiles of such rows are compared by their
    codes, and only counts and connecting pairs leave a tile, never all pairs. epsilon: width of the confidence
    interval; where the certain bound is narrower it is used instead, so for 64 dimensions and 0.9 nothing is lost. Null, empty and
    zero vectors and those with null or non-finite components link with nothing, and neither do vectors of different lengths.
    Ids should be unique; a repeated id gives repeated rows that count as vectors. An empty table gives no rows. Other columns
    are not read. Work grows with the square of the number of different vectors, 64 code bits a pair for 64 dimensions.
    """
    rows = stage(vector_bytes(df, id_col, vector_col), "vectors")
    whole = rows.where("vec is not null")
    classes = stage(whole.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    # Tiles hold vectors of one length; `number` of them each, about `tile` rows in one.
    per_length = classes.groupBy(F.length("vec").alias("size")).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("number"))
    numbered = classes.join(per_length, F.length("vec") == F.col("size")).withColumn(
        "t", F.expr("cast(pmod(xxhash64(rep), number) as int)")
    )
    pairs = numbered.select(
        "size", "rep", "copies", "vec", "t",
        F.explode(F.expr("sequence(0, number - 1)")).alias("other"),
    ).select(
        "size", "rep", "copies", "vec",
        F.least("t", "other").alias("i"), F.greatest("t", "other").alias("j"),
        (F.col("t") < F.col("other")).alias("is_left"),
    )

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        # Rows in a fixed order, so that a repeated task gives the same connecting pairs.
        group = group.sort_values("rep", ignore_index=True)
        left, right = group, None
        if group["i"].iat[0] != group["j"].iat[0]:
            left = group[group["is_left"]].reset_index(drop=True)
            right = group[~group["is_left"]].reset_index(drop=True)
            if left.empty or right.empty:
                return pd.DataFrame({"a": [], "b": [], "links": []})
        reps, links, edges, _ = compare_tile(left, right, threshold, epsilon)
        linked = links > 0
        found = pd.DataFrame({"a": reps[linked], "b": pd.array([None] * int(linked.sum()), "Int64"), "links": links[linked]})
        joined = pd.DataFrame({"a": [a for a, _ in edges], "b": pd.array([b for _, b in edges], "Int64"), "links": 0})
        return pd.concat([found, joined])

    # Dealt out in a fixed number of parts: by their bytes all pairs of tiles would end up in one task.
    found = stage(
        spread(pairs, "size", "i", "j").groupBy("size", "i", "j").applyInPandas(compared, "a long, b long, links long"), "tile-links"
    )
    direct = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    grouped = components(found.where("b is not null").select("a", "b"))
    known = (
        classes.join(direct, F.col("rep") == F.col("a"), "left")
        .join(grouped, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vec").alias("_vec"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(known, F.col("vec") == F.col("_vec"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
