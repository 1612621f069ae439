"""Merkle manifest of a table: a tree per source over its rows, and a tree over the sources' roots.

Every ARITY consecutive nodes become one. Only every STORED_EVERY-th level is written; between two written levels the nodes
form aligned subtrees of at most ARITY ** STORED_EVERY stored nodes. A proof walks from the root down: each
subtree's missing nodes are recomputed from its stored ones where they are needed, give their siblings, and are not kept.
No subtree depends on the size of a source, so a source with a third of all rows is spread like any other.
All of it is SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import running_start
from granary.staging import scratch_path

ARITY = 3
STORED_EVERY = 3
_SPAN = ARITY**STORED_EVERY

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Manifest:
    """Stored levels of the trees of the sources and of the tree above them, lowest first.

    sources: (source, place, node) and, in the lowest level, what the rows carry; top: (place, node), the lowest with source.
    root is None for a table without rows.
    """

    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def leaf(**replaced: Column) -> Column:
    """Hash of a row: each of FIELDS as `-` if null, else its UTF-8 byte count, `:` and its value."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def _parents(nodes: Column) -> Column:
    """The next level of a subtree; its last run may be shorter."""
    return F.transform(
        F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY)),
        lambda i: F.sha2(F.array_join(F.slice(nodes, i, ARITY), ""), 256),
    )


def _rises(nodes: Column) -> Column:
    """Whether a subtree's level has a level above it. Only the first subtree of a tree can hold all of a level."""
    return (F.col("_subtree") > 0) | (F.size(nodes) > 1)


def _subtrees(level: DataFrame, tree: list[str], item: Column) -> DataFrame:
    """Aligned subtrees over a stored level: (tree, _subtree, _items by place, _level0 .. _level{STORED_EVERY}).

    A group holds at most ARITY ** STORED_EVERY rows whatever the table's size.
    """
    found = level.groupBy(*tree, F.expr(f"place div {_SPAN}").alias("_subtree")).agg(
        F.sort_array(F.collect_list(F.struct("place", item.alias("item")))).alias("_sorted")
    )
    found = found.select(*tree, "_subtree", F.col("_sorted.item").alias("_items"))
    found = found.withColumn("_level0", F.col("_items.node"))
    for k in range(STORED_EVERY):
        below = F.col(f"_level{k}")
        found = found.withColumn(f"_level{k + 1}", F.when(_rises(below), _parents(below)).otherwise(below))
    return found


def _build(nodes: DataFrame, tree: list[str], path: str) -> list[DataFrame]:
    """Stored levels over (tree, place, node), the last with one node a tree. `nodes` must be written already."""
    levels = [nodes]
    widest = (nodes.agg(F.max("place")).first()[0] or 0) + 1
    while widest > 1:
        above = _subtrees(levels[-1], tree, F.struct("node")).select(
            *tree, F.col("_subtree").alias("place"), F.element_at(f"_level{STORED_EVERY}", 1).alias("node")
        )
        levels.append(_put(above, f"{path}-{len(levels)}"))
        widest = -(-widest // _SPAN)
    return levels


def _put(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_manifest(docs: DataFrame, path: str | None = None, **carried: Column) -> Manifest:
    """Writes the stored levels of `docs` below `path` (default: a fresh shared folder).

    `carried` columns are kept beside each leaf. Rows are ordered by doc_id (nulls first) within a source, rows that
    share an id by their leaf; repeated rows have a leaf each. Other columns of `docs` play no part.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "merkle")
    rows = docs.select(
        "doc_id", "source", leaf().alias("node"), *[c.alias(name) for name, c in carried.items()], F.lit(1).cast("long").alias("_one")
    )
    placed = running_start(rows, ["source"], ["doc_id", "node"], "_one", "place").drop("_one")
    sources = _build(_put(placed, f"{path}/source-0"), ["source"], f"{path}/source")
    roots = sources[-1].select("source", "node", F.lit(1).cast("long").alias("_one"))
    ordered = running_start(roots, [], ["source"], "_one", "place").drop("_one")
    top = _build(_put(ordered, f"{path}/top-0"), [], f"{path}/top")
    last = top[-1].first()
    return Manifest(sources, top, last["node"] if last else None)


def _descend(levels: list[DataFrame], tree: list[str], paths: DataFrame, kept: list[str]) -> DataFrame:
    """Paths of the lowest level's nodes, from those of the highest: (tree, kept, path) with what the level carries.

    path has a (left, right) pair for each level between the node and the root: its run's other nodes.
    """
    for k in range(len(levels) - 2, -1, -1):
        carried = [c for c in levels[k].columns if c not in (*tree, "place")]
        found = _subtrees(levels[k], tree, F.struct(*carried))
        above = paths.select(*[F.col(c).alias(f"_{c}") for c in (*tree, *kept)], F.col("place").alias("_place"), F.col("path").alias("_above"))
        match = F.col("_subtree") == F.col("_place")
        for c in tree:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        rows = found.join(above, match).select(
            *tree, *[F.col(f"_{c}").alias(c) for c in kept], "_subtree", "_above",
            *[f"_level{j}" for j in range(STORED_EVERY)], F.posexplode("_items").alias("_i", "_item"),
        )
        steps = []
        for j in range(STORED_EVERY):
            nodes, at = F.col(f"_level{j}"), F.expr(f"_i div {ARITY**j}").cast("int")
            within = at % ARITY
            left = F.array_join(F.slice(nodes, at - within + 1, within), "")
            right = F.array_join(F.slice(nodes, at + 2, F.lit(ARITY - 1) - within), "")
            steps.append(F.when(_rises(nodes), F.struct(left.alias("left"), right.alias("right"))))
        paths = rows.select(
            *tree, *kept, (F.col("_subtree") * _SPAN + F.col("_i")).alias("place"),
            *[F.col("_item")[c].alias(c) for c in carried],
            F.concat(F.array_compact(F.array(*steps)), "_above").alias("path"),
        )
    return paths


def proofs(manifest: Manifest) -> DataFrame:
    """Every row with its proof: source, place, doc_id, node (the leaf), what it carries, subroot and path.

    path is an array of (left, right), from the leaf up to the root: the texts of the run's nodes before and after.
    """
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = _descend(manifest.top, [], manifest.top[-1].withColumn("path", nothing), []) if len(manifest.top) > 1 else (
        manifest.top[0].withColumn("path", nothing)
    )
    subroots = above.select("source", F.lit(0).cast("long").alias("place"), F.col("node").alias("subroot"), "path")
    if len(manifest.sources) > 1:
        return _descend(manifest.sources, ["source"], subroots, ["subroot"])
    return manifest.sources[0].join(
        subroots.select(F.col("source").alias("_source"), "subroot", "path"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")


def folded(node: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, node, lambda acc, s: digest(s["left"], acc, s["right"]))


def siblings_digest(path: str = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def is_tampered(id_col: str = "doc_id") -> Column:
    """Rows that the check alters: 2 divides the crc32 of the id as text. Null ids are left alone."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def manifest_check(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): proofs of all rows, held against altered texts.

    Where `is_tampered`, folded_root starts from the leaf of the text without its line feeds. Null texts stay null. No rows give no rows.
    """
    tampered = F.when(is_tampered(), leaf(text=F.replace("text", F.lit("\n"), F.lit("")))).otherwise(leaf())
    manifest = write_manifest(docs, _now=tampered)
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest).select(
        "doc_id", F.col("node").alias("leaf"), "subroot", root.alias("root"),
        siblings_digest().alias("proof_sha256"), folded(F.col("_now")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
