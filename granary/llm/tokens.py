"""Public tokenizers applied to whole texts.

The word tokenizer drops white space and never joins across it, so a text's ids are those
of its white-space separated parts one after the other. Texts are taken in slices of about
SLICE_BYTES; each different part of a slice is looked at once. The lower-cased pieces of parts also repeat between slices, so
each Python worker keeps the ids of pieces until they take CACHE_BYTES; beyond that, pieces are encoded
again in each slice.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from granary.llm.text import buffers, slices

#: Memory a worker spends on remembered pieces, at ENTRY_BYTES a piece besides its letters and ids.
CACHE_BYTES = 80 << 20
ENTRY_BYTES = 190
SLICE_BYTES = 4 << 20

# Characters whose lower-casing, normal form and class do not differ between libraries.
_PLAIN = re.compile("[!-~¡-¬®-į]+").fullmatch
# The splitting pattern of the public file word_bpe_49k.json, and the settings that go with it.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_PIECES = regex.compile(_SPLIT).findall
_SPACES = np.arange(256, dtype=np.uint8)
_SPACES[[0x09, 0x0A, 0x0D]] = 0x20


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit integers, without special tokens added.

    Files that split or normalise in another way than the public word tokenizer go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        self.by_parts = (spec["normalizer"], spec["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER) and all(
            added["special"] and added["content"].startswith("<|") for added in spec["added_tokens"]
        )
        self.tokenize = self.library.model.tokenize
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {"": b""}
        self.room = CACHE_BYTES

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text]))).tobytes()

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; null counts as empty."""
        for a, z in slices(texts, SLICE_BYTES):
            if self.by_parts:
                yield from self._slice(texts[a:z])
            else:
                for text in texts[a:z].to_pylist():
                    yield np.array(self.library.encode(text or "", add_special_tokens=False).ids, "<u4")

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        raw, offsets = buffers(texts)
        bounds = offsets - offsets[0]
        spaced = pa.LargeStringArray.from_buffers(
            len(texts), pa.py_buffer(bounds), pa.py_buffer(_SPACES[raw[offsets[0]: offsets[-1]]])
        )
        split = pc.split_pattern(spaced, " ")
        parts = split.flatten().dictionary_encode()
        known, part = self.pieces, self._part
        # A part that is a known piece with nothing to lower-case is looked up at once.
        found = [known[p] if p in known else part(p) for p in parts.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        # From each part's place among the different ones to its place in the texts.
        at = parts.indices.to_numpy()
        each = sizes[at]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(each)))
        ids = flat[np.arange(ends[-1]) + np.repeat(begins[at] - ends[:-1], each)]
        cuts = ends[split.offsets.to_numpy()].tolist()
        for a, z in zip(cuts[:-1], cuts[1:]):
            yield ids[a:z]

    def _part(self, part: str) -> bytes:
        if part.isascii() and part[:-1].isalpha() and " " < part[-1] < "\x7f":
            # Letters, then a letter or one other sign, which is a piece of its own.
            low = part.lower()
            return self._pieces((low,) if low.isalpha() else (low[:-1], low[-1]))
        if _PLAIN(part) and "<|" not in part:
            return self._pieces(_PIECES(part.lower()))
        return _packed(self.library.encode(part, add_special_tokens=False).ids)

    def _pieces(self, found: tuple[str, ...] | list[str]) -> bytes:
        known = self.pieces
        return b"".join([known[p] if p in known else self._piece(p) for p in found])

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = _packed([t.id for t in self.tokenize(letters)])
        if self.room > 0:
            self.room -= ENTRY_BYTES + 2 * len(piece) + len(ids)
            self.pieces[piece] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of that file, kept between tasks."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def public_path(name: str) -> str:
    """Place of a public vocabulary file; resolved where it is called."""
    import public_tokenizers

    return public_tokenizers.path(name)
