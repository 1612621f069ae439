"""Exact top-k inner products by MaxScore.

A query's terms are its dimensions. A term's posting list holds the rows to whose score it adds: those whose component has the query's
sign there. Lists are kept per block of rows, with the most that each can add. Terms in order of falling bound are split where the
bounds of the rest no longer reach the k-th best score so far: only rows in an essential term's list can compete. Those lists
are traversed; the rows found are then probed in the other terms, largest bound first, and for what essential terms take away, as
long as what is left could bring them in. A block whose bounds together don't reach the k-th best score is passed over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.vectors import matrix, vector_bytes
from granary.staging import stage

SHARD = 16384
QUERY_BLOCK = 1024
STEP = 4096


class Block:
    """Some rows of a shard in order of their ids: components by dimension, and two posting lists of each dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids = ids
        self.terms = np.ascontiguousarray(values.T)
        self.lists = []
        for mask, most in ((self.terms > 0, self.terms.max(1)), (self.terms < 0, self.terms.min(1))):
            dimension, row = np.nonzero(mask)
            cuts = np.searchsorted(dimension, np.arange(len(self.terms) + 1))
            self.lists.append((cuts, row.astype(np.int32), self.terms[mask], most))

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The most that each term adds to the score of a row."""
        return np.maximum(0, np.where(query > 0, query * self.lists[0][3], query * self.lists[1][3]))

    def postings(self, term: int, positive: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a term's list, and their components."""
        cuts, rows, values, _ = self.lists[0 if positive else 1]
        return rows[cuts[term]: cuts[term + 1]], values[cuts[term]: cuts[term + 1]]


class Shard:
    """Rows of one shard, in blocks. `probed` counts the components looked up outside of posting lists."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.blocks = [Block(ids[order[at: at + STEP]], values[order[at: at + STEP]]) for at in range(0, len(ids), STEP)]
        self.probed = 0

    def search(self, query: np.ndarray, k: int, but: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, id), highest first, ties to the smaller id; without id `but`."""
        best_scores, best_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = None
        for block in self.blocks if k > 0 else ():
            score, found = self._block(block, query, least)
            if but is not None:
                score, found = score[found != but], found[found != but]
            best_scores, best_ids = np.append(best_scores, score), np.append(best_ids, found)
            top = np.lexsort((best_ids, -best_scores))[:k]
            best_scores, best_ids = best_scores[top], best_ids[top]
            if len(top) == k:
                least = best_scores[-1]
        return list(zip(best_scores.tolist(), best_ids.tolist()))

    def _block(self, block: Block, query: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the rows of a block that can have more than `least`: later ids lose ties."""
        bounds = block.bounds(query)
        order = np.argsort(-bounds, kind="stable")
        # rest[i]: the most that the terms from the i-th on can add.
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        if least is None or least < 0:
            # Rows to which no term adds can come in too: all are probed in all terms.
            self.probed += block.terms.size
            return query @ block.terms, block.ids
        essential = int(np.flatnonzero(rest <= least)[0])
        adds, listed = np.zeros(len(block.ids), np.int64), np.zeros(len(block.ids), bool)
        for term in order[:essential].tolist():
            if query[term]:
                rows, values = block.postings(term, query[term] > 0)
                adds[rows] += values * query[term]
                listed[rows] = True
        alive = np.flatnonzero(listed & (adds + rest[essential] > least))
        score = adds[alive]
        for i in [*range(essential, len(order)), *range(essential)]:
            if not len(alive):
                break
            term = order[i]
            values = block.terms[term, alive] * query[term]
            self.probed += len(alive)
            # Of essential terms what they add is in the score already.
            score = score + (np.minimum(values, 0) if i < essential else values)
            stays = score + (rest[i + 1] if i >= essential else 0) > least
            alive, score = alive[stays], score[stays]
        return score, block.ids[alive]


def top_k(
    df: DataFrame,
    queries: str = "vec_id % 100 = 0",
    k: int = 10,
    scale: float = 1024.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product of floor(scale * x).

    queries: condition on vec_id that names the query rows; each is held against all rows but its own. All of them if
    fewer than k; ties go to the smaller vec_id. Null or empty vectors and those with null or non-finite components take no part; neither
    do vectors of another length than the query's. Scores are 64-bit integers; a row with a null id takes no part. Rows that repeat an id count
    as rows of their own, but for the query's. An empty table gives no rows. Queries and rows meet in blocks of bounded size, and
    each block passes on k rows a query.
    """
    spark = df.sparkSession
    rows = stage(vector_bytes(df, id_col, vector_col, scale, keep_zero=True).where("vec is not null and vec_id is not null"), "vectors")
    asked = rows.where(queries)
    n_rows, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // shard)), max(1, -(-n_asked // query_block))
    hashed = lambda n: F.expr(f"cast(pmod(xxhash64(vec_id), {n}) as int)")
    held = rows.select(
        "vec_id", "vec", F.lit(False).alias("asks"), hashed(shards).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("q")
    )
    asking = asked.select(
        "vec_id", "vec", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), hashed(blocks).alias("q")
    )

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        for _, same in group.groupby(group["vec"].str.len()):
            against, ask = same[~same["asks"]], same[same["asks"]]
            if against.empty or ask.empty:
                continue
            index = Shard(against["vec_id"].to_numpy(np.int64), matrix(against["vec"].tolist(), "<i8"))
            for query, vec in zip(ask["vec_id"].tolist(), matrix(ask["vec"].tolist(), "<i8")):
                out += [(query, i, s) for s, i in index.search(vec, k, but=query)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (
        held.unionByName(asking.select(*held.columns))
        .groupBy("s", "q")
        .applyInPandas(searched, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
