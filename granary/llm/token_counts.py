"""Token counts of whole texts by heap-and-linked-list byte-pair merging.

A text's symbols form a linked list; a heap yields the adjacent pair of lowest rank again and
again. Each merge takes one symbol away, so the count is symbols minus merges, and no
ids are made. Merges never cross two neighbouring letters that no vocabulary entry
holds side by side, so texts are cut there and the counts of up to CACHE_PARTS repeated
parts are kept per Python worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from granary.llm.common import ship
from granary.llm.tokens import public_path

CACHE_PARTS = 500_000
CACHE_LETTERS = 64
SPACE = "▁"


class PairMerger:
    """Counts tokens from merge ranks alone.

    ranks: rank of each vocabulary entry, lower merges first, ties from the left.
    cost of a symbol that is no entry: its UTF-8 bytes (byte fallback).
    """

    def __init__(self, ranks: dict[str, float], prefix: str = SPACE):
        self.ranks = ranks
        self.prefix = prefix
        self.pairs = {p[i: i + 2] for p in ranks for i in range(len(p) - 1)}
        self.whole: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        # Words are cut off before each run of spaces, if no entry holds a space after a letter.
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ranks)
        self.segments = (lambda s: [s]) if crossing else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def count(self, text: str | None) -> int:
        """Tokens of a text; null and empty texts have none."""
        if not text:
            return 0
        known = self.whole
        return sum(
            [known[s] if s in known else self._segment(s) for s in self.segments(self.prefix + text.replace(" ", SPACE))]
        )

    def _segment(self, segment: str) -> int:
        pairs, start, total = self.pairs, 0, 0
        for i in range(1, len(segment) + 1):
            if i == len(segment) or segment[i - 1: i + 1] not in pairs:
                part = segment[start:i]
                n = self.parts.get(part)
                if n is None:
                    n = self.merge(part)
                    if len(part) <= CACHE_LETTERS and len(self.parts) < CACHE_PARTS:
                        self.parts[part] = n
                total += n
                start = i
        if len(segment) <= CACHE_LETTERS and len(self.whole) < CACHE_PARTS:
            self.whole[segment] = total
        return total

    def merge(self, part: str) -> int:
        """Symbols minus merges."""
        ranks = self.ranks
        symbols = list(part)
        n = len(symbols)
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in ranks:
                heap.append((ranks[pair], i, len(pair)))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            # Out of date: the left symbol is gone, or either side has grown since.
            if not symbols[i] or j < 0 or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            count -= 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                pair = symbols[i] + symbols[k]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, len(pair)))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + symbols[i]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], h, len(pair)))
        for s in symbols:
            if len(s) == 1 and s not in ranks:
                count += len(s.encode()) - 1
        return count


def piece_merger(path: str) -> PairMerger:
    """Ranks of a piece model file: every ordinary entry, by falling score."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ordinary = (
        i for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    )
    return PairMerger({model.id_to_piece(i): -model.get_score(i) for i in ordinary})


_loaded: dict[str, PairMerger] = {}


def _merger(name: str) -> PairMerger:
    if name not in _loaded:
        _loaded[name] = piece_merger(public_path(name) if "/" not in name else name)
    return _loaded[name]


def count_tokens(
    docs: DataFrame,
    model: str = "piece_bpe_32k.model",
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Bytes and tokens of every text: (id, n_bytes, n_tokens, over_limit).

    model: a public vocabulary's name, or the path of a piece model. One row per input
    row, in any order; repeated rows give repeated rows, an empty table an empty one. Null and
    empty texts have 0 bytes and tokens. A null id stays null. Other columns are not read, so
    their names may clash with the results'. No shuffle; a worker holds one Arrow batch.
    """
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(model)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            tokens = [merger.count(t.as_py()) for t in texts]
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        counted, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
