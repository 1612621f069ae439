"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection.

Two sets of Jaccard similarity t or more share an element among the first (1 - t) of each, in any order common to all; so
tiles gather the documents that share such a prefix element, and sizes within the band that t allows. The order is by document
count, rarest first, read from a table of fixed size of hashed counts, so the elements of shared lines and passages
stand in few prefixes. Bitmaps bound the overlap from above before two sets are intersected. First each document is held against the
smallest of its tile. Then the bitmaps of the others are compared inside the tiles, and a pair leaves its tile only if its ends are
not connected by then, so what is written grows with the rows of tiles, not with their pairs. Texts are never shuffled: sets and
bitmaps are taken where the documents are read, of those alone that a bitmap of the ids wanted lets through. Where a pair that left turns out not similar, the
sets of the documents it connected are held against each other inside a task, and links alone leave it, in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import components, likely, ship, spread
from granary.llm.text import mix, shingle_sets, signed, slices, words
from granary.staging import discard, stage

SHINGLE_WORDS = 5
#: Fewest bits of a bitmap; a larger set has a power of two of at least BITS_AN_ELEMENT bits an element. At 6 to 12 bits, pairs
#: that miss a similarity of 0.75 by 0.03 or more seldom pass.
BITS = 256
BITS_AN_ELEMENT = 6
#: Bits of a bitmap that travel with the rows of a tile at most; wider ones are folded.
TILE_BITS = 1 << 14
#: Hashed document counts that order the elements: so many, whatever the number of documents. Elements that meet in one
#: only change the order, which costs time, never a link.
COUNTS = 1 << 22
_COUNT_PARTS = 64
#: Rows of a tile that one group holds at most twice; larger tiles are compared part by part.
TILE_ROWS = 4096
#: Elements of the sets that one group holds at most about twice where sets themselves are compared.
PART_ELEMENTS = 1 << 20

_U = np.uint64


def bitmap(found: np.ndarray) -> np.ndarray:
    """Bits as signed 64-bit words: for each element's hash h, bit h modulo the number of bits is set."""
    width = max(BITS, 1 << (BITS_AN_ELEMENT * len(found) - 1).bit_length()) if len(found) else BITS
    bits = np.zeros(width, np.uint8)
    bits[(mix(found ^ _U(0x5851F42D4C957F2D)) & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view("<i8")


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for a, z in slices(texts):
        for i, found in enumerate(shingle_sets(words(texts[a:z]), size)):
            yield a + i, found


def _fingerprint(found: np.ndarray) -> tuple[int, int]:
    if not len(found):
        return 0, 0
    pair = np.array([mix(found).sum(), mix(found ^ _U(0x9E3779B97F4A7C15)).sum()], _U)
    return tuple(signed(pair).tolist())


def _slot(elements: np.ndarray) -> np.ndarray:
    return (mix(elements ^ _U(0xD1B54A32D192ED03)) & _U(COUNTS - 1)).astype(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    """Counts (int32), all first bytes before all second ones: of most counts only the first is not zero, and takes few bits."""
    return zlib.compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, bits, part, counts): a row per document, part NULL; and _COUNT_PARTS rows per task with its
    table of hashed document counts, equal sets of the task counted once."""
    step = COUNTS // _COUNT_PARTS
    names = ["doc_id", "n_shingles", "f1", "f2", "bits", "part", "counts"]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.int32(), pa.binary()]

    def signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(COUNTS, np.int32), set()
        for batch in batches:
            sizes, prints, bits = [], [], []
            for _, found in _sets(batch.column(1), size):
                mark = _fingerprint(found)
                sizes.append(len(found))
                prints.append(mark)
                bits.append(bitmap(found))
                if mark not in seen:
                    seen.add(mark)
                    # Set by set: those of a batch together, and the arrays made of them, are many times its text.
                    np.add.at(counts, _slot(found), 1)
            n = batch.num_rows
            columns = [batch.column(0), sizes, [p[0] for p in prints], [p[1] for p in prints], bits, [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if seen:
            tables = [_packed(counts[k * step: (k + 1) * step]) for k in range(_COUNT_PARTS)]
            none = [None] * _COUNT_PARTS
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([none] * 5 + [range(_COUNT_PARTS), tables], kinds)], names)

    return docs.mapInArrow(signed_rows, "doc_id long, n_shingles long, f1 long, f2 long, bits array<long>, part int, counts binary")


def count_levels(tables: DataFrame) -> np.ndarray:
    """For each slot of the table, a level that rises with the number of documents whose elements fall there, as bytes.

    The tasks' tables are added part by part. The driver gets COUNTS bytes, whatever the input.
    """
    step = COUNTS // _COUNT_PARTS

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + _unpacked(packed).astype(np.int64)
        if sums:
            levels = [np.minimum(8 * np.log2(1.0 + c), 255).astype(np.uint8).tobytes() for c in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["part", "levels"])

    out = np.zeros(COUNTS, np.uint8)
    for row in tables.repartition(_COUNT_PARTS, "part").mapInArrow(added, "part int, levels binary").collect():
        out[row["part"] * step: (row["part"] + 1) * step] = np.frombuffer(row["levels"], np.uint8)
    return out


def prefixes(docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(key, doc_id, n) for each prefix element of each different set of a task's rows."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = shared.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0)
            keys, owners, sizes = [], [], []
            for i, found in _sets(batch.column(1), size):
                n = len(found)
                if not n or not ids[i].is_valid or (mark := _fingerprint(found)) in seen:
                    continue
                seen.add(mark)
                take = n - -(-percent * n // 100) + 1
                # Sets are sorted by hash, so a stable sort by level orders all alike.
                order = np.argsort(level_of[_slot(found)], kind="stable")[:take]
                keys.append(found[order])
                owners.append(np.full(take, ids[i].as_py()))
                sizes.append(np.full(take, n))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(owners)), pa.array(np.concatenate(sizes).astype(np.int32))],
                    ["key", "doc_id", "n"],
                )

    return docs.mapInArrow(cut, "key long, doc_id long, n int")


def _folded(bits: np.ndarray, words_wide: int) -> np.ndarray:
    while len(bits) > words_wide:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def tile_pairs(
    ids: np.ndarray, sizes: np.ndarray, parts: np.ndarray, open_: np.ndarray, bits: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Pairs of one tile whose bitmaps allow the similarity, between rows of different `parts`.

    Two parts with a pair count as one from then on. open_ rows have no bitmap that bounds them.
    """
    order = np.lexsort((ids, sizes))
    ids, sizes, parts, open_ = ids[order], sizes[order].astype(np.int64), parts[order].copy(), open_[order]
    bits = [bits[i] for i in order]
    wide = np.array([len(b) for b in bits])
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out = []
    for i in range(len(ids) - 1):
        if (parts == parts[0]).all():
            break
        width = wide[i]
        if width not in tables:
            # A row is compared with larger ones, whose bitmaps are as wide or wider; then they are folded.
            rows = np.flatnonzero(wide >= width)
            tables[width] = rows, np.stack([_folded(bits[j], width) for j in rows])
        rows, table = tables[width]
        near = (rows > i) & (percent * sizes[rows] <= 100 * sizes[i]) & (parts[rows] != parts[i])
        if open_[i] or open_.any():
            near |= (rows > i) & (parts[rows] != parts[i]) & (open_[rows] | open_[i])
        rows, table = rows[near], table[near]
        if not len(rows):
            continue
        mine = bits[i]
        overlap = np.minimum(
            sizes[i] - np.bitwise_count(mine & ~table).sum(1, dtype=np.int64), sizes[rows] - np.bitwise_count(table & ~mine).sum(1, dtype=np.int64)
        )
        allowed = 100 * overlap >= percent * (sizes[i] + sizes[rows] - overlap)
        for j in rows[allowed | open_[rows] | open_[i]].tolist():
            if parts[j] == parts[i]:
                continue
            a, b = sorted((int(ids[i]), int(ids[j])))
            out.append((a, b))
            parts[parts == parts[j]] = parts[i]
    return out


def set_links(
    ids: np.ndarray, parts: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links between rows of different `parts` and different `sides`, by counting the elements that two sets share.

    Two parts with a link count as one from then on, so there are fewer links than rows.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort((ids, sizes))
    ids, parts, sides, sizes = ids[order], parts[order].copy(), sides[order], sizes[order]
    first = np.cumsum(sizes) - sizes
    names, elements = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    held = np.zeros(len(names), np.int32)
    out = []
    for i in range(len(ids) - 1):
        rows = i + 1 + np.flatnonzero(
            (parts[i + 1:] != parts[i]) & (sides[i + 1:] != sides[i]) & (percent * sizes[i + 1:] <= 100 * sizes[i])
        )
        if not len(rows):
            continue
        begins = np.cumsum(sizes[rows]) - sizes[rows]
        theirs = elements[np.repeat(first[rows] - begins, sizes[rows]) + np.arange(sizes[rows].sum())]
        mine = elements[first[i]: first[i] + sizes[i]]
        held[mine] = 1
        shared = np.add.reduceat(held[theirs], begins)
        held[mine] = 0
        for j in rows[100 * shared >= percent * (sizes[i] + sizes[rows] - shared)].tolist():
            if parts[j] != parts[i]:
                out.append(tuple(sorted((int(ids[i]), int(ids[j])))))
                parts[parts == parts[j]] = parts[i]
    return out


def _bound(percent: int, a: str, b: str) -> str:
    """Condition that the bitmaps of two rows allow the similarity."""
    # Sizes that may be similar have bitmaps of one width, or one of them has twice the other's and is folded.
    half = lambda x: f"size({x}.bits) div 2"
    folded = lambda x, y: (
        f"if(size({x}.bits) > size({y}.bits), zip_with(slice({x}.bits, 1, {half(x)}), "
        f"slice({x}.bits, {half(x)} + 1, {half(x)}), (p, q) -> p | q), {x}.bits)"
    )
    only = lambda x, y: f"aggregate(zip_with({folded(x, y)}, {folded(y, x)}, (p, q) -> bit_count(p & ~q)), 0, (s, v) -> s + v)"
    # An element that sets a bit the other lacks is not shared.
    overlap = f"least({a}.n_shingles - {only(a, b)}, {b}.n_shingles - {only(b, a)})"
    return f"100 * {overlap} >= {percent} * ({a}.n_shingles + {b}.n_shingles - {overlap})"


def element_sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(id, elements) of the documents `needed`, ids in its only column, and of a few others: their sorted shingle hashes."""

    def arrays(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [signed(s).tobytes() for _, s in _sets(batch.column(1), size)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "elements"])

    return likely(docs, "doc_id", needed, arrays, "id long, elements binary")


def by_group(
    rows: DataFrame, keys: list[str], schema: str, done: Callable[[tuple, list[tuple]], list[tuple[int, int]]]
) -> DataFrame:
    """(a, b) that `done` finds in each group of equal `keys`, the first columns of `rows`, from the other columns."""
    n = len(keys)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(at: tuple, group: list[tuple]) -> pa.RecordBatch:
            pairs = done(at, group)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        at, group = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:n] != at:
                    if group:
                        yield links(at, group)
                    at, group = row[:n], []
                group.append(row[n:])
        if group:
            yield links(at, group)

    return spread(rows, *keys).sortWithinPartitions(*keys).mapInArrow(found, schema).distinct()


def in_parts(rows: DataFrame) -> DataFrame:
    """`rows` (with doc_id and the number of `parts` of their group) under each two parts p <= q of their group: all pairs
    meet, no group is large. own is the row's part."""
    own = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    each = rows.select("*", own.alias("own"), other.alias("other")).drop("parts")
    return each.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")}).drop("other")


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough, by intersection of sorted arrays.

    Each side's sets are taken where the documents are read: that reads them twice, but no set is shuffled for a side it is not on.
    """
    a, b = (element_sets(docs, pairs.select(side), size) for side in ("a", "b"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(b.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
        .join(a.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
        .select("a", "b", "x", "y")
        .mapInArrow(similar, "a long, b long")
        .distinct()
    )


def jaccard_components(
    docs: DataFrame,
    percent: int = 75,
    shingle_words: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: documents link when 100 * intersection >= percent * union.

    Words are lower-cased in A-Z; a text with fewer words than a shingle is one shingle; null texts and texts without
    words are empty and link with nothing. component_id is the smallest doc_id reachable. Rows that share a doc_id are one document with
    several sets, each in a row. A null doc_id links with nothing and has a null component. Other columns are not read. An
    empty table gives no rows. No link is lost: tiles are complete, and bitmaps only bound from above.
    """
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed_ = stage(signatures(own, shingle_words), "signatures")
    sig = signed_.where("part is null").drop("part", "counts")
    levels = count_levels(signed_.where("part is not null").select("part", "counts"))

    # Equal sets: one class each, joined to its smallest document.
    filled = sig.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    copies = stage(
        filled.join(classes.where("rows > 1"), ["f1", "f2"]).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")),
        "copies",
    )

    # Tiles of the same documents are one: near copies share most of their prefixes.
    in_tile = Window.partitionBy("key")
    tiles = stage(
        prefixes(own, shingle_words, percent, levels)
        .withColumn("tile", F.bit_xor(F.xxhash64("doc_id")).over(in_tile))
        .withColumn("leader", F.min(F.struct("n", "doc_id")).over(in_tile))
        .withColumn("last", F.max(F.struct("n", "doc_id")).over(in_tile))
        .where("leader.doc_id <> last.doc_id")
        .select(F.col("tile").alias("key"), "doc_id", "n", F.col("leader.doc_id").alias("leader"), F.col("leader.n").alias("leader_n"))
        .distinct(),
        "tiles",
    )
    sized_ = sig.where("doc_id is not null").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("rows"))

    def bitmaps(needed: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, bits, rows) of the documents `needed`, ids in its only column, and of a few others."""
        mine = likely(sig.select("doc_id", "n_shingles", "bits"), "doc_id", needed)
        found = mine.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "bits")).alias("s"), F.count(F.lit(1)).alias("rows"))
        return found.select("doc_id", "s.n_shingles", "s.bits", "rows")

    def bounded(pairs: DataFrame) -> DataFrame:
        """Pairs that the bitmaps allow; a document of several rows is always allowed."""
        one = bitmaps(pairs.select("a").union(pairs.select("b")))
        a = one.select(F.col("doc_id").alias("a"), F.struct("n_shingles", "bits", "rows").alias("x"))
        b = one.select(F.col("doc_id").alias("b"), F.struct("n_shingles", "bits", "rows").alias("y"))
        return pairs.join(b, "b").join(a, "a").where(f"x.rows > 1 or y.rows > 1 or {_bound(percent, 'x', 'y')}").select("a", "b")

    led = tiles.where(f"doc_id <> leader and 100 * leader_n >= {percent} * n")
    led = stage(led.select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b")).distinct(), "led")
    star = stage(bounded(led), "star")

    def open_rows(links: DataFrame) -> DataFrame:
        """Rows of the tiles whose ends lie in different components of `links` and copies.

        Leaders are left out, as `star` has held them against all of their tile.
        """
        groups = components(links.union(copies))
        marked = tiles.where("doc_id <> leader or n <> leader_n").join(groups, F.col("doc_id") == F.col("node"), "left").select(
            "key", "doc_id", "n", F.coalesce("component", "doc_id").alias("c")
        )
        open_keys = marked.groupBy("key").agg(
            F.min("c").alias("lo"), F.max("c").alias("hi"), F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("parts")
        ).where("lo <> hi").select("key", "parts")
        return stage(in_parts(marked.join(open_keys, "key")).select("key", "p", "q", "doc_id", "n", "c"), "open")

    def unconnected(rows: DataFrame) -> DataFrame:
        """Allowed pairs of a tile of open rows whose ends lie in different components; see `tile_pairs`."""

        def folded_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [_folded(np.array(b, np.int64), TILE_BITS // 64).tobytes() for b in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["_d", "bits", "open"])

        small = bitmaps(rows.select("doc_id")).select(F.col("doc_id").alias("_d"), "bits", (F.col("rows") > 1).alias("open"))
        small = small.mapInArrow(folded_bits, "_d long, bits binary, open boolean")
        full = rows.join(small, F.col("doc_id") == F.col("_d")).select("key", "p", "q", "doc_id", "n", "c", "open", "bits")

        def allowed(at: tuple, group: list[tuple]) -> list[tuple[int, int]]:
            ids, sizes, parts, open_, bits = zip(*group)
            return tile_pairs(
                np.array(ids), np.array(sizes), np.array(parts), np.array(open_, bool), [np.frombuffer(b, np.uint64) for b in bits], percent
            )

        return by_group(full, ["key", "p", "q"], "a long, b long", allowed)

    def missed(pairs: DataFrame, linked: DataFrame) -> DataFrame:
        """Links inside the components of `pairs` and copies, between different components of `linked`.

        Pairs that are not in a component of `pairs` together are not allowed by their bitmaps. Of copies the first stands for all.
        """
        held = components(pairs.union(copies)).withColumnRenamed("component", "g").join(
            linked.withColumnRenamed("component", "c"), "node", "left"
        ).select(F.col("node").alias("doc_id"), "g", F.coalesce("c", "node").alias("c"))
        split = held.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("g")
        later = sized_.where("rows = 1").join(copies, F.col("doc_id") == F.col("b"), "left_semi").select("doc_id")
        rows = held.join(split, "g").join(later, "doc_id", "left_anti").join(sized_.select("doc_id", F.expr("n_shingles * rows").alias("n")), "doc_id")
        rows = stage(rows.select("g", "doc_id", "c", "n"), "split")
        parts = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum("n") / PART_ELEMENTS)).cast("int")
        sized = in_parts(rows.join(rows.groupBy("g").agg(parts.alias("parts")), "g"))
        full = sized.join(element_sets(own, rows.select("doc_id"), shingle_words), F.col("doc_id") == F.col("id"))

        def linking(at: tuple, group: list[tuple]) -> list[tuple[int, int]]:
            ids, comps, sides, sets = zip(*group)
            # Two different parts meet here; each has a group of its own.
            sides = np.arange(len(group)) if at[1] == at[2] else np.array(sides)
            return set_links(np.array(ids), np.array(comps), sides, [np.frombuffer(s, _U) for s in sets], percent)

        return by_group(full.select("g", "p", "q", "doc_id", "c", "own", "elements"), ["g", "p", "q"], "a long, b long", linking)

    # Held as connected for now: what the bitmaps allow. Where an intersection then fails, the sets of what it connected are
    # held against each other themselves, so no more pairs leave a task than there are rows.
    opened = open_rows(star)
    pairs = stage(star.union(unconnected(opened)).distinct(), "pairs")
    discard(tiles, led, star, opened)
    links = stage(verified(pairs, own, shingle_words, percent), "links")
    groups = stage(components(links.union(copies)), "groups")
    done = [signed_, copies, pairs, links, groups]
    if stage(pairs.exceptAll(links), "failed").head(1):
        more = stage(missed(pairs, groups), "links")
        done.append(more)
        if more.head(1):
            groups = components(links.union(more).union(copies))
    classes = stage(sig.join(groups, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    ), "classes")
    discard(*done)
    return classes
