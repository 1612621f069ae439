"""Operators of the training-data pipeline against brute force, and on awkward rows."""

import collections
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import (
    embedding_dedup, encoded_ids, mixing, ngram_join, packing, passage_dedup, spans, suffix_dedup, text,
    token_counts, tokens, top_k, toxicity,
)
from granary.llm.common import components, running_start

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_tokens long"
_rng = np.random.default_rng(5)
WORDS = [f"w{i}" for i in range(4000)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def edited(base, every):
    parts = base.split()
    return " ".join(f"x{i}" if i % every == every - 1 else w for i, w in enumerate(parts))


BASE, PASSAGE = prose(300, 1), prose(80, 2)
TEXTS = {
    1: BASE, 2: BASE, 3: edited(BASE, 60), 4: None, 5: "", 6: "  \n\t ", 7: "one", 8: "One", 9: "a b c d",
    10: prose(120, 3) + " " + PASSAGE + " " + prose(90, 4), 11: prose(60, 5) + "\n" + PASSAGE, 12: prose(200, 6),
    13: "same same " * 400, 14: "Ünïcode ß İ 中文 😀 é <s> <|endoftext|> ▁x", 15: prose(20_000, 7), 16: edited(BASE, 23),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 0.5, 7) for i, t in TEXTS.items()]
    return spark.createDataFrame([*rows, (None, "no id", None, "s1", 5, 0.1, 1)], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def word_list(value):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (value or "").encode())
    return re.findall(rb"[^\x20\x09-\x0d]+", data)


def test_words_and_their_hashes():
    values = ["A b\tc", "", None, "a  B", "x" * 5000 + " a", "é\x0bÉ"]
    found = text.words(pa.array(values))
    assert np.diff(found.first).tolist() == [len(word_list(v)) for v in values]
    a, b = found.hashes[0], found.hashes[1]
    assert found.hashes[3] == a and found.hashes[4] == b and found.hashes[6] == a
    assert len(set(found.hashes.tolist())) == 6


def test_token_counts_equal_the_library(docs, empty):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=tokens.public_path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in token_counts.count_tokens(docs).collect()}
    for i, value in TEXTS.items():
        assert got[i]["n_tokens"] == len(model.encode(value or "")), i
        assert got[i]["n_bytes"] == len((value or "").encode())
        assert got[i]["over_limit"] == (got[i]["n_tokens"] > 4096)
    assert token_counts.count_tokens(empty).collect() == []
    merger = token_counts.piece_merger(tokens.public_path("piece_bpe_32k.model"))
    for odd in (" ", "\n\n", "aaaa" * 60, " " * 50 + "x", "\x00\x01", "1,000.5", "ﬁ Ａ", "​x", "<0x0A>"):
        assert merger.count(odd) == len(model.encode(odd)), odd


def test_word_tokenizer_equals_the_library():
    own = tokens.WordTokenizer(tokens.public_path("word_bpe_49k.json"))
    odd = ["It's <|endoftext|>a b", "a\x1cb c", "ΣΑΣ é ﬁ", "'S DON'T ''ve", "<|startoftext|>", "12٣½", *filter(None, TEXTS.values())]
    for value in odd:
        ids = np.frombuffer(own.encode(value), "<u4").tolist()
        assert ids == own.library.encode(value, add_special_tokens=False).ids


def test_word_tokenizer_on_batches():
    own = tokens.WordTokenizer(tokens.public_path("word_bpe_49k.json"))
    values = ["", None, " ", "\t\n", "A.", "ab\x7f", "ab\x00", "abc12.", "x<|", "'", "a' A. ab\x1c", None, "abc12. a\rA.", ""]
    want = [own.library.encode(v or "", add_special_tokens=False).ids for v in values]
    for _ in range(2):
        assert [x.tolist() for x in own.encode_all(pa.array(values))] == want
    assert [x.tolist() for x in own.encode_all(pa.array(values)[3:9])] == want[3:9]
    assert list(own.encode_all(pa.array([], pa.string()))) == []


def test_jaccard_components_by_brute_force(docs, empty):
    sets = {}
    for i, value in TEXTS.items():
        w = word_list(value)
        sets[i] = {tuple(w[k: k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = {k: low if v == high else v for k, v in parent.items()}
    got = {r["doc_id"]: r for r in ngram_join.jaccard_components(docs).collect()}
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (len(sets[i]), parent[i]), i
    assert got[None]["component_id"] is None
    assert ngram_join.jaccard_components(empty).collect() == []


def test_repeated_passages_by_brute_force(docs, empty):
    where = collections.defaultdict(set)
    listed = {i: word_list(t) for i, t in TEXTS.items()}
    for i, w in listed.items():
        for k in range(len(w) - 49):
            where[tuple(w[k: k + 50])].add(i)
    want = {i: np.zeros(len(w), bool) for i, w in listed.items()}
    for i, w in listed.items():
        for k in range(len(w) - 49):
            if len(where[tuple(w[k: k + 50])]) > 1:
                want[i][k: k + 50] = True
    got = {i: np.zeros(len(w), bool) for i, w in listed.items()}
    for r in suffix_dedup.repeated_passages(docs).collect():
        got[r["doc_id"]][r["low"]: r["high"]] = True
        assert r["first_doc_id"] <= r["doc_id"] and r["n_words"] == r["high"] - r["low"] >= 50
    for i in listed:
        assert (got[i] == want[i]).all(), i
    assert suffix_dedup.repeated_passages(empty).collect() == []


def test_minimisers_are_the_minima_of_windows():
    grams = _rng.integers(0, 50, 300).astype(np.uint64)
    want = sorted({k + i for k in range(300 - 9) for i in range(10) if grams[k + i] == grams[k: k + 10].min()})
    assert suffix_dedup.minimisers(grams, 10).tolist() == want


def test_compact_windows_hold_each_stretch_once():
    values = _rng.integers(0, 2**63, 60).astype(np.uint64)
    nodes = passage_dedup.compact_windows(values, 8)
    for low in range(60):
        for high in range(low + 7, 60):
            holding = [c for l, c, r in nodes if l <= low <= c <= high <= r]
            assert holding == [low + int(values[low: high + 1].argmin())]


def test_near_passages_are_found_and_cut(docs, empty):
    got = collections.defaultdict(list)
    for r in passage_dedup.near_duplicate_passages(docs).collect():
        got[r["doc_id"]].append((r["low"], r["high"], r["first_doc_id"]))
    assert got[2] == [(0, 300, 1)]
    assert sum(high - low for low, high, _ in got[3]) >= 280
    (low, high, first), = got[11]
    assert first == 10 and abs(low - 60) <= 5 and high == 140
    assert set(got) <= {2, 3, 11, 16}
    left = {r["doc_id"]: r for r in spans.cut_out(docs, passage_dedup.near_duplicate_passages(docs)).collect()}
    assert 2 not in left and left[1]["text"] == BASE and left[4]["text"] is None and left[12]["text"] == TEXTS[12]
    assert left[11]["text"].split() == TEXTS[11].split()[:low] and left[11]["n_chars"] == len(left[11]["text"])
    assert passage_dedup.near_duplicate_passages(empty).collect() == []


def test_huffman_codes_are_optimal_and_limited():
    counts = np.array([50, 0, 1, 1, 3, 9, 27, 81, 243])
    free = encoded_ids.code_lengths(counts, 30)
    assert sum(2.0 ** -n for n in free[free > 0]) == 1 and free[1] == 0
    # The optimum: 8 symbols with these counts need 843 bits in all.
    order = sorted(counts[counts > 0].tolist())
    total = 0
    while len(order) > 1:
        pair = order.pop(0) + order.pop(0)
        total += pair
        order = sorted([*order, pair])
    assert int((free * counts).sum()) == total
    short = encoded_ids.code_lengths(counts, 4)
    assert short.max() <= 4 and sum(2.0 ** -n for n in short[short > 0]) <= 1
    ids = _rng.choice(np.flatnonzero(counts), 5000)
    for lengths in (free, short):
        bits, checks = encoded_ids.pack_bits(ids, lengths, encoded_ids.canonical_codes(lengths))
        assert (encoded_ids.unpack_bits(bits, checks, len(ids), encoded_ids.decode_table(lengths)) == ids).all()


def test_encoded_files_read_back(spark, docs, empty, tmp_path):
    library = tokens.WordTokenizer(tokens.public_path("word_bpe_49k.json"))
    encoded_ids.write_encoded(docs.where("doc_id is not null"), str(tmp_path / "a"))
    rows = sorted(encoded_ids.encoded_summary(spark, str(tmp_path / "a")).collect())
    start = 0
    for row, (i, value) in zip(rows, sorted(TEXTS.items()), strict=True):
        ids = library.encode(value or "") + (1).to_bytes(4, "little")
        assert tuple(row) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    encoded_ids.write_encoded(empty, str(tmp_path / "b"))
    assert encoded_ids.encoded_summary(spark, str(tmp_path / "b")).collect() == []


def test_packing_keeps_every_piece_once(docs, empty):
    rows = packing.pack_documents(docs).collect()
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    # Full pieces and those longer than half a sequence stand alone; middle ones fit beside none of these.
    rest = [r["length"] for r in rows if r["length"] < 2048]
    long = [n for n in rest if n > 1024]
    middle = [n for n in rest if 2048 - min(long) < n <= 1024]
    assert len(by_sequence) == len(rows) - len(rest) + len(long) + -(-sum(middle) // 2048)
    assert {r["doc_id"] for r in rows} == {*TEXTS, None}
    assert packing.pack_documents(empty).collect() == []


@pytest.mark.parametrize("select", ["dot", "norm"])
def test_bins_meet_every_capacity(select):
    counts = {n: int(c) for n, c in enumerate(_rng.integers(0, 9, 100)) if n}
    bins = packing.plan_bins(counts, 120, 5, 10_000, select=select)
    used = collections.Counter()
    for taken, times in bins:
        assert sum(n * c for n, c in taken.items()) <= 120
        assert sum(taken.values()) <= 5
        assert sum(n * n * c for n, c in taken.items()) <= 10_000
        for n, c in taken.items():
            used[n] += c * times
    assert used == collections.Counter({n: c for n, c in counts.items() if c})
    with pytest.raises(ValueError, match="capacity"):
        packing.plan_bins({130: 1}, 120, 5, 10**6)


def test_mix_targets_and_draws(docs, empty):
    goal = mixing.targets({"a": 100, "b": 1000, None: 10})
    assert goal[None] == 20 * 0.5 or goal[None] <= 20
    assert abs(sum(goal.values()) - 1665) < 1e-6 and goal["a"] == 200
    first = sorted(map(tuple, mixing.mix_digest(docs).collect()), key=str)
    assert first == sorted(map(tuple, mixing.mix_digest(docs).collect()), key=str)
    taken, target = collections.Counter(), {}
    for r in mixing.mix_digest(docs).collect():
        assert r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    for source, words in taken.items():
        assert abs(words - target[source]) <= 2 * mixing.BLOCK_WORDS
    assert mixing.mix_digest(empty).collect() == []
    quotas = np.array([500, 3, 0, 77])
    shards = [mixing.shard_counts(quotas, 7, s, 1) for s in range(7)]
    assert (sum(here for here, _ in shards) == quotas).all()
    assert (shards[6][1] + shards[6][0] == quotas).all()
    for n in (1, 2, 3, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 9).tolist()) == list(range(n))


def test_materialized_mix_has_the_words_taken(docs):
    _, drawn = mixing.mix(docs.where("doc_id is not null"))
    taken = {r["doc_id"]: r["n"] for r in drawn.selectExpr("doc_id", "high - low as n").groupBy("doc_id").sum("n").toDF("doc_id", "n").collect()}
    got = collections.Counter()
    for r in mixing.materialize(docs, drawn).collect():
        got[r["doc_id"]] += len(word_list(r["text"]))
    assert got == taken


VECTORS = "vec_id long, embedding array<float>, n_links long"


@pytest.fixture(scope="module")
def vectors(spark):
    base = _rng.standard_normal((40, 16))
    near = base[:10] + 0.12 * _rng.standard_normal((10, 16))
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*base, *near, base[0], base[0], 3 * base[1]])]
    rows += [(100, None, 0), (200, [0.0] * 16, 0), (300, [None] + [1.0] * 15, 0), (400, [float("nan")] * 16, 0), (500, [], 0), (600, [1.0, 2.0], 0)]
    return spark.createDataFrame(rows, VECTORS).repartition(4)


def test_embedding_links_by_brute_force(spark, vectors):
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    sound = {i: np.array(v, float) for i, v in rows.items() if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = {i: [j for j, w in sound.items() if j != i and len(w) == len(v) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9] for i, v in sound.items()}
    component = {i: i for i in rows}
    for _ in rows:
        for i, others in links.items():
            component[i] = min([component[i], *(component[j] for j in others)])
    for tile in (7, 8192):
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(vectors, tile=tile).collect()}
        for i in rows:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, [])), component[i], component[i] == i), i
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_code_estimates_are_unbiased_and_bounded():
    unit = _rng.standard_normal((2000, 64))
    unit[1000:] = 0.9 * unit[:1000] + 0.5 * unit[1000:]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    codes, factor, turned = embedding_dedup.encode(unit)
    signs = (np.unpackbits(codes, axis=1) * 2.0 - 1) / 8
    product = (signs[:1000] * turned[1000:]).sum(1)
    true = (unit[:1000] * unit[1000:]).sum(1)
    assert abs((product / factor[:1000] - true).mean()) < 0.01
    high = true >= 0.9
    assert high.any() and (product >= embedding_dedup.lowest_estimate(factor[:1000], 64, 0.9, 4.0))[high].all()


def test_top_k_by_brute_force(spark, vectors):
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    sound = {i: np.floor(1024 * np.array(v, float)).astype(int) for i, v in rows.items() if v and None not in v and np.isfinite(v).all()}
    for shard, block in ((9, 2), (16384, 1024)):
        got = collections.defaultdict(list)
        for r in sorted(top_k.top_k(vectors, "vec_id % 10 = 0", 5, shard=shard, query_block=block).collect()):
            got[r["query_id"]].append((-r["score"], r["vec_id"]))
        for q in [i for i in sound if i % 10 == 0]:
            others = sorted((-int(sound[q] @ v), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))
            assert got[q] == others[:5], q
    assert top_k.top_k(spark.createDataFrame([], VECTORS)).collect() == []


def test_toxicity_learns_from_documents_and_locates_sentences(spark, empty):
    clean = [prose(40, 100 + i).replace(" w1", ". w1") for i in range(300)]
    rows = [(i, t + (". You badword here. " if i % 6 == 0 else ". ") + t, 0.0) for i, t in enumerate(clean)]
    docs = spark.createDataFrame([*rows, (900, None, 0.0), (901, "", 0.0), (902, "...", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(300)] + [(5, None), (None, 1), (5, 9)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert len(got) == 303 and got[900]["score"] == got[901]["score"] == got[902]["score"] == 0
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    held = [i for i in range(300) if got[i]["held_out"]]
    assert all(got[i]["predicted"] == int(i % 6 == 0) for i in held)
    model = toxicity.fit(docs, labels)
    found = toxicity.locate(docs, model).collect()
    assert {r["doc_id"] for r in found} == {i for i in range(300) if i % 6 == 0}
    assert all("badword" in r["sentence"] for r in found)
    assert toxicity.toxicity_scores(empty, labels.limit(0)).collect() == []
    one_sided = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs.drop("score"), one_sided).where("score > 0.5").count() == 0


def test_components_and_running_sums(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(150, 200)] + [(300, 300), (401, 400)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 150 for i in range(150, 201)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    rows = [(i % 3 if i % 7 else None, i, i % 5) for i in range(200)]
    out = running_start(spark.createDataFrame(rows, "g int, k long, v long").repartition(6), ["g"], ["k"], "v", "before").collect()
    for r in out:
        assert r["before"] == sum(v for g, k, v in rows if g == r["g"] and k < r["k"])


@pytest.mark.parametrize("others", [1, 40])
def test_passages_around_a_frequent_line_meet_each_other(spark, others):
    rows, pairs = [], range(25)
    for p in pairs:
        line = prose(22, 1000 + p)
        passage = prose(16, 2000 + p) + " " + line + " " + prose(17, 3000 + p)
        rows += [(1000 * p + i, prose(70, 90_000 + 100 * p + i) + " " + line + " " + prose(70, 50_000 + 100 * p + i)) for i in range(others)]
        rows += [(1000 * p + 500 + i, prose(70, 7000 + 10 * p + i) + " " + passage + " " + prose(70, 8000 + 10 * p + i)) for i in range(3)]
    got = collections.defaultdict(list)
    for r in passage_dedup.near_duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got[r["doc_id"]].append((r["low"], r["high"], r["first_doc_id"]))
    for p in pairs:
        for i in (1, 2):
            (low, high, first), = got.pop(1000 * p + 500 + i)
            assert first == 1000 * p + 500 and abs(low - 70) <= 4 and abs(high - 125) <= 4
    assert not got


@pytest.mark.parametrize("n, every, added", [(10_000, 40, 0), (20_000, 100, 0), (10_000, 60, 1)])
def test_long_near_copies_with_a_moving_shift(n, every, added):
    base = _rng.integers(0, 2**63, n).astype(np.uint64)
    if added:
        copy = np.insert(base, np.arange(every, n, every), np.arange(len(range(every, n, every)), dtype=np.uint64))
    else:
        copy = np.delete(base, np.arange(every, n, every))
    x, y = text.gram_hashes(base, 5), text.gram_hashes(copy, 5)
    assert passage_dedup.near_stretches(x, y, 46, 75) == [(0, len(y))]


def test_parts_of_a_failed_stretch_are_verified():
    base = _rng.integers(0, 2**63, 4000).astype(np.uint64)
    # Two good parts side by side whose originals lie far apart: as one stretch they span too much of x.
    copy = np.concatenate((base[:400], base[3000:3400]))
    x, y = text.gram_hashes(base, 5), text.gram_hashes(copy, 5)
    found = passage_dedup.near_stretches(x, y, 46, 75)
    assert sum(high - low for low, high in found) >= 780


def test_passages_that_reach_left_of_a_line_in_many_documents(spark):
    rows, want = [], {}
    for p in range(20):
        line, before = prose(40, 11_000 + p), prose(10, 12_000 + p)
        for i in range(30):
            rows.append((100 * p + i, prose(60, 13_000 + 100 * p + i) + " " + line + " " + prose(60, 16_000 + 100 * p + i)))
        for i in (40, 41):
            rows.append((100 * p + i, prose(60, 19_000 + 100 * p + i) + " " + before + " " + line + " " + prose(60, 22_000 + 100 * p + i)))
            want[100 * p + i] = (60, 110, 100 * p + 40)
    # A passage that stands twice in the first of its documents.
    twice = prose(55, 25_000)
    rows += [(9000, f"{prose(70, 1)} {twice} {prose(70, 2)} {twice} {prose(9, 3)}"), (9001, f"{twice} {prose(30, 4)}")]
    want[9001] = (0, 55, 9000)
    got = collections.defaultdict(list)
    for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got[r["doc_id"]].append((r["low"], r["high"], r["first_doc_id"]))
    assert sorted(got.pop(9000)) == [(70, 125, 9000), (195, 250, 9000)]
    assert got == {i: [span] for i, span in want.items()}


@pytest.mark.parametrize("low, high", [(0, 50), (-50, 50), (-5, 1)])
def test_top_k_beyond_the_first_step_of_a_shard(monkeypatch, low, high):
    monkeypatch.setattr(top_k, "STEP", 8)
    values = _rng.integers(low, high, (200, 6))
    index = top_k.Shard(np.arange(200), values)
    for query in (-_rng.integers(1, 50, 6), _rng.integers(-50, 50, 6), np.zeros(6, np.int64)):
        want = sorted((-int(v @ query), i) for i, v in enumerate(values) if i != 3)[:10]
        assert [(-s, i) for s, i in index.search(query, 10, but=3)] == want


def test_mix_takes_each_row_for_itself(spark):
    rows = [
        (None, prose(700, 31), "en", "s1", 0, 0.5, 7), (None, prose(90, 32), "en", "s1", 0, 0.5, 7), (None, None, "en", "s1", 0, 0.5, 7),
        *[(1, prose(500, 33), "en", "s1", 0, 0.5, 7)] * 2, (2, prose(400, 34), "en", "s2", 0, 0.5, 7), (3, prose(300, 35), "en", "s3", 0, 0.5, 7),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    digest = mixing.mix_digest(docs).collect()
    assert len(digest) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in digest)
    by_source = collections.Counter()
    for r in digest:
        by_source[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(n - target) <= 2 * mixing.BLOCK_WORDS for (_, target), n in by_source.items())
    got = corpus_pipeline.mix_sources(spark, docs, "")
    assert got.columns == docs.columns
    taken, texts = 0, {t: set(t.split()) for _, t, *_ in rows if t}
    for r in got.collect():
        taken += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and any(set(r["text"].split()) <= held for held in texts.values())
    assert taken == sum(r["taken"] for r in digest)


@pytest.mark.parametrize("scale", [1, 10**9])
def test_shard_counts_are_multinomial_draws_at_any_size(scale):
    quotas = np.array([5_000, 300, 0, 7_700], np.int64) * scale
    shards = [mixing.shard_counts(quotas, 7, s, 1) for s in range(7)]
    assert (sum(here for here, _ in shards) == quotas).all() and min(here.min() for here, _ in shards) >= 0
    assert all((shards[i][0] + shards[i][1] == shards[i + 1][1]).all() for i in range(6))
    # A shard's count of a source is binomial: mean quota / shards, variance quota * p * (1 - p), within what 600 draws tell.
    drawn = np.array([mixing.shard_counts(quotas, 7, 3, seed)[0] for seed in range(600)], float)
    spread = np.sqrt(quotas * 6 / 49)
    held = quotas > 0
    assert (abs(drawn.mean(0) - quotas / 7)[held] <= 5 * spread[held] / 600**0.5).all()
    assert (abs(drawn.std(0) - spread)[held] <= 0.15 * spread[held]).all() and not drawn[:, ~held].any()


def test_packing_rows_under_each_capacity(spark):
    lengths = [int(n) for n in _rng.integers(1, 61, 300)]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "k long, length long").repartition(3)
    for limits in ((120, 3, 14_400), (120, 120, 4_000), (120, 3, 4_000)):
        placed = collections.defaultdict(list)
        for r in packing.pack(rows, ["k"], *limits).collect():
            assert r["length"] == lengths[r["k"]]
            placed[r["sequence_id"]].append((r["offset"], r["length"]))
        assert sorted(placed) == list(range(len(placed))) and sum(map(len, placed.values())) == 300
        for held in placed.values():
            held.sort()
            assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist()
            assert sum(n for _, n in held) <= limits[0] and len(held) <= limits[1] and sum(n * n for _, n in held) <= limits[2]
        # They bind: without them fewer sequences do.
        free = packing.pack(rows, ["k"], limits[0]).agg({"sequence_id": "max"}).first()[0] + 1
        assert len(placed) > free


def test_foreign_tokenizer_files_go_through_the_library(tmp_path, spark, docs):
    import json
    import os

    plain = tokens.public_path("word_bpe_49k.json")
    spec = json.load(open(plain))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    path = os.path.join(tmp_path, "other.json")
    json.dump(spec, open(path, "w"))
    assert tokens.WordTokenizer(plain).by_parts and not tokens.WordTokenizer(path).by_parts
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    got = collections.defaultdict(list)
    for r in packing.piece_ids(docs, 64, path, end_id=None).collect():
        got[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for i, value in TEXTS.items():
        assert sum((ids for _, ids in sorted(got[i])), []) == library.encode(value or "", add_special_tokens=False).ids


def test_packed_pieces_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json"))
    want = []
    for i, value in [*TEXTS.items(), (None, "no id")]:
        ids = [*library.encode(value or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at: at + 2048]
            want.append((i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_cache_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 2000)
    own = tokens.WordTokenizer(tokens.public_path("word_bpe_49k.json"))
    value = prose(3000, 77)
    assert own.encode(value) == own.encode(value) == np.array(own.library.encode(value, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(own.pieces) <= 12


def test_top_k_probes_candidates_only(monkeypatch):
    monkeypatch.setattr(top_k, "STEP", 64)
    values = _rng.normal(size=(1024, 32))
    values[::5] = 0.3 * values[::5] + values[7]
    values = np.floor(100 * values).astype(np.int64)
    index = top_k.Shard(np.arange(1024), values)
    for i in range(0, 1024, 100):
        want = sorted((-int(v @ values[i]), j) for j, v in enumerate(values) if j != i)[:10]
        assert [(-s, j) for s, j in index.search(values[i], 10, but=i)] == want
    assert 0 < index.probed < 0.8 * 11 * values.size
    # A block that holds nothing but the opposite of the query is not looked at.
    far = top_k.Shard(np.arange(128), np.concatenate((np.ones((64, 4), np.int64), -np.ones((64, 4), np.int64))))
    assert [i for _, i in far.search(np.ones(4, np.int64), 10)] == list(range(10)) and far.probed == 64 * 4


def test_toxicity_scores_are_the_noisy_or_of_sentences():
    names = ["bad", "awful", "fine", "É"]
    found = text.words(pa.array([" ".join(names)]), text.LETTERS_ONLY).hashes
    order = np.argsort(found)
    weights = {"bad": 3.0, "awful": 1.5, "fine": -2.0, "é": 0.7}
    model = toxicity.Model(-2.5, found[order], np.array([3.0, 1.5, -2.0, 0.7])[order])
    values = [
        "bad fine. awful!\nnothing here", "bad bad awful", None, "", " . ! ", "É fine", "fine. " * 40_000 + "bad awful", "bad fine. awful!\nnothing here",
    ]

    def plain(value):
        clean = 1.0
        for sentence in re.split(r"[.!?\n\r]", value or ""):
            spoken = re.findall(r"[0-9a-z\u0080-￿]+", re.sub("[A-Z]", lambda m: m[0].lower(), sentence))
            if spoken:
                z = -2.5 + sum(weights.get(w.replace("É", "é"), 0.0) if w != "É" else 0.7 for w in spoken)
                clean *= 1 - 1 / (1 + np.exp(-z))
        return 1 - clean

    got = toxicity.document_scores(model, pa.array(values))
    assert np.allclose(got, [plain(v) for v in values]) and got[0] == got[-1] and got[2] == got[3] == got[4] == 0


def test_near_passages_are_found_at_the_threshold(spark):
    """Planted passages with words changed, dropped and put in, against the similarity of their shingles."""
    rows, near, exact = [], [], []
    for p in range(60):
        rng = np.random.default_rng(40_000 + p)
        passage = prose(int(rng.integers(60, 160)), 50_000 + p).split()
        changed = list(passage)
        for _ in range(p % 5):
            at = int(rng.integers(0, len(changed)))
            changed[at: at + 1] = [[], ["new", "words"], [f"y{p}"]][int(rng.integers(0, 3))]
        sets = [{tuple(w[i: i + 5]) for i in range(len(w) - 4)} for w in (passage, changed)]
        similar = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        rows.append((10 * p, " ".join([prose(80, 60_000 + p), *passage, prose(50, 61_000 + p)])))
        rows.append((10 * p + 1, " ".join([prose(30, 62_000 + p), *changed, prose(90, 63_000 + p)])))
        if changed == passage:
            exact.append(10 * p + 1)
        elif similar >= 0.75:
            near.append(10 * p + 1)
    found = {r["doc_id"] for r in passage_dedup.near_duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert set(exact) <= found and len(near) > 25
    assert len(found & set(near)) >= 0.9 * len(near) and found <= {i for i, _ in rows if i % 10 == 1}


def test_pipeline_stages_on_awkward_rows(spark):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in TEXTS.items()]
    rows += [(1, "another text of one id.", "en", "s1", 9), (None, "no id", None, "s1", 5), (None, None, None, None, None)] + rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = "/tmp/none"
    kept = {}
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.stage(stage(spark, docs, labels))
        kept[name] = docs.count()
        if name == "ngram_join":
            ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
            assert ids.count(None) == 2 and ids.count(1) == 1 and 2 not in ids and 3 not in ids
            first = sorted(map(str, docs.collect()))
    again = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert sorted(map(str, corpus_pipeline.one_of_each_group(spark, again, labels).collect())) == first
    assert kept["packing"] > 0


def test_near_misses_leave_no_more_pairs_than_rows(spark, monkeypatch):
    """Copies whose bitmaps allow the similarity and whose sets lack it a little, but for a few that link."""
    # Two of them differ in 33 of 396 shingles, which is 0.846 for 0.85.
    base, n = prose(400, 70_000).split(), 24
    places, rows = np.random.default_rng(71_000).permutation(np.arange(1, 75)), []
    for i in range(n):
        own = list(base)
        for at in places[3 * i: 3 * i + 3]:
            own[5 * at + 2] = f"z{i}"
        rows.append((i, " ".join([*own[:-3], *[f"end{i}"] * 3])))
    rows += [(n + i, t) for i, t in rows[:3]] + [(n + 3, rows[5][1].replace(base[1], "other", 1)), (7, rows[20][1])]
    held = collections.defaultdict(list)
    for i, t in rows:
        w = t.split()
        held[i].append({tuple(w[k: k + 5]) for k in range(len(w) - 4)})
    parent = {i: i for i in held}
    for i in held:
        for j in held:
            if i < j and any(100 * len(x & y) >= 85 * len(x | y) for x in held[i] for y in held[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = {k: low if v == high else v for k, v in parent.items()}
    staged = {}

    def counted(df, label):
        out = plain(df, label)
        staged[label] = max(staged.get(label, 0), out.count())
        return out

    plain = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counted)
    monkeypatch.setattr(ngram_join, "PART_ELEMENTS", 4000, raising=False)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 85).collect()
    assert len(set(parent.values())) == n - 1
    assert {r["doc_id"]: r["component_id"] for r in got} == parent
    assert staged["pairs"] <= 4 * n and staged["links"] <= 4 * n


def test_scores_and_words_live_in_little_memory():
    """Numpy arrays of a slice, of which each worker of an executor holds several at once."""
    import tracemalloc

    texts = pa.array([prose(3000, 80_000 + i) for i in range(300)])
    model = toxicity.Model(-6.0, np.zeros(0, np.uint64), np.zeros(0))
    tracemalloc.start()
    toxicity.document_scores(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 4 << 20 and peak < 32 << 20


def test_wanted_documents_are_found_without_a_shuffle_of_texts(spark):
    rows = [(i, f"a b c d e f {i}") for i in [*range(-50, 3000), 1 << 40, -(1 << 40), 5, 5]] + [(None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = [-50, -1, 0, 5, 2999, 1 << 40, -(1 << 40)]
    needed = spark.createDataFrame([(i,) for i in [*wanted, None, 123456]], "a long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sets = ngram_join.element_sets(docs, needed, 5)
        assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()
        got = collections.Counter(r["id"] for r in sets.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [got[i] for i in wanted] == [1, 1, 1, 3, 1, 1, 1] and None not in got
    assert len(got) < len(wanted) + 20
    assert ngram_join.element_sets(docs, needed.where("a = 5"), 5).count() >= 3
    assert ngram_join.element_sets(docs, needed.where("a is null"), 5).collect() == []


def test_tiles_of_two_are_compared_once(spark, monkeypatch):
    """Documents that share one passage with one other each, and two that link: a tile's smallest is held against all at once."""
    rows = [(i, f"{prose(30, 90_000 + i)} {prose(12, 91_000 + i // 2)}") for i in range(40)]
    rows += [(100, prose(80, 93_000)), (101, prose(80, 93_000) + " more")]
    staged = {}

    def counted(df, label):
        out = plain(df, label)
        staged[label] = out.count()
        return out

    plain = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counted)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: min(i, 100) for i, _ in rows}
    assert staged["tiles"] > 0 and staged["open"] == 0


def test_wanted_sets_take_one_worker_a_task(spark):
    """An executor keeps all workers it ever needed at once, each with its memory; two functions in a row need two."""
    docs = spark.createDataFrame([(i, f"a b c d e f {i}") for i in range(50)], "doc_id long, text string")
    sets = ngram_join.element_sets(docs, docs.select("doc_id").where("doc_id < 5"), 5)
    assert sets._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["id"]: np.frombuffer(r["elements"], np.uint64).size for r in sets.collect()}.items() >= {i: 3 for i in range(5)}.items()


def test_pairs_are_verified_by_the_sets_of_their_own_side(spark, monkeypatch):
    """Sets are the largest rows of the join: those of one side are not shuffled for the other."""
    docs = spark.createDataFrame([(i, prose(60, 94_000) + f" {i}" * (i % 2)) for i in range(300)], "doc_id long, text string").repartition(3)
    pairs = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(1, 2)], "a long, b long")
    sizes, plain = [], ngram_join.element_sets

    def counted(*given):
        sizes.append(plain(*given).count())
        return plain(*given)

    monkeypatch.setattr(ngram_join, "element_sets", counted)
    got = ngram_join.verified(pairs, docs, 5, 75)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect()))
    assert len(sizes) == 2 and min(sizes) < 10 and sum(sizes) < 310


def test_document_counts_travel_in_few_bytes():
    counts = np.random.default_rng(95_000).poisson(0.7, 1 << 16).astype(np.int32)
    counts[[3, 9, 27]] = 300, 70_000, 2_000_000_000
    packed = ngram_join._packed(counts)
    assert (ngram_join._unpacked(packed) == counts).all() and len(packed) < 0.4 * len(counts)


def test_ngram_join_leaves_no_tiles_behind(spark, monkeypatch):
    """What only the candidate step reads is deleted when its pairs are written, before sets are shuffled."""
    docs = spark.createDataFrame([(i, prose(80, 96_000 + i // 3) + f" {i}") for i in range(60)], "doc_id long, text string").repartition(3)
    at, plain = {}, ngram_join.stage

    def kept(df, label):
        out = plain(df, label)
        at[label] = out._staged_at
        return out

    monkeypatch.setattr(ngram_join, "stage", kept)
    assert {r["component_id"] for r in ngram_join.jaccard_components(docs).collect()} == set(range(0, 60, 3))
    assert at.keys() >= {"tiles", "led", "star", "open", "links"}
    assert [label for label in ("tiles", "led", "star", "open") if os.path.exists(at[label].removeprefix("file:"))] == []


def test_signatures_hold_no_sets_of_a_whole_batch():
    """A batch's sets together, and the arrays made of them, take many times its text in each worker of an executor."""
    import tracemalloc

    class Worker:
        mapInArrow = staticmethod(lambda function, schema: function)

    ids, texts = pa.array(range(800)), pa.array([prose(1500, 97_000 + i) for i in range(800)])
    run = ngram_join.signatures(Worker, 5)
    tracemalloc.start()
    rows = list(run(iter([pa.RecordBatch.from_arrays([ids, texts], ["doc_id", "text"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    tables = [ngram_join._unpacked(t) for t in rows[1].column(6).to_pylist()]
    assert sum(int(t.sum()) for t in tables) == sum(rows[0].column(1).to_pylist()) and peak < 48 << 20


def test_discard_lets_spark_drop_shuffles_of_plans_that_are_gone(spark):
    import time

    from granary.staging import discard, stage

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    mine = lambda: {f for f in map(str, files.getAllBlocks().mkString(",").split(",")) if f.startswith("shuffle_")}
    deal = lambda: stage(spark.range(100_000).withColumn("k", F.col("id") % 1000).repartition(7, "k"), "dealt")
    before = mine()
    staged = deal()
    made = mine() - before
    assert made
    for _ in range(3):
        discard(staged)
        staged = deal()
        time.sleep(1)
    assert not made & mine()


def test_passages_shuffle_wanted_texts_and_each_side_its_own(spark, monkeypatch):
    docs = [(i, prose(70, 98_000 + i)) for i in range(2000)] + [(5000, prose(70, 98_007)[:-3] + " x"), (5001, prose(70, 98_011))]
    wanted, plain = [], passage_dedup.likely

    def counted(*given):
        out = plain(*given)
        wanted.append(out.count())
        return out

    monkeypatch.setattr(passage_dedup, "likely", counted, raising=False)
    staged, kept = {}, passage_dedup.stage
    monkeypatch.setattr(passage_dedup, "stage", lambda df, label: staged.setdefault(label, kept(df, label)))
    got = passage_dedup.near_duplicate_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(5000, 7), (5001, 11)}
    assert wanted and max(wanted) < 20
    assert sorted((r["d"], r["side"]) for r in staged["passages"].collect()) == [(7, "a"), (5000, "b")]


def test_pairs_in_large_window_groups_are_all_compared(spark):
    """Lines of 42 words in 60 documents; some share eight words more around them with one other, a passage of 50 words."""
    rows, want = [], {}
    for p in range(8):
        line = prose(42, 80_000 + p)
        for i in range(60):
            front, back = prose(60, 81_000 + 100 * p + i), prose(60, 83_000 + 100 * p + i)
            if i >= 20:
                pair = 20 * p + (i - 20) // 2
                front += " " + prose(3, 85_000 + pair)
                back = prose(5, 87_000 + pair) + " " + back
                if i % 2:
                    want[100 * p + i] = 100 * p + i - 1
            rows.append((100 * p + i, f"{front} {line} {back}"))
    found = passage_dedup.near_duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["first_doc_id"] for r in found} == want


def test_group_stretches_by_brute_force():
    rng = np.random.default_rng(91_000)
    line, passage = rng.integers(0, 2**32, 30), [rng.integers(0, 2**32, 123) for _ in range(4)]
    groups, rows = [], []
    for g in range(3):
        for i in range(40):
            own = rng.integers(0, 2**32, 123)
            if i % 3:
                own = passage[(g + i) % 4].copy()
                own[rng.integers(0, 123, int(rng.integers(0, 14)))] += 1
                if i % 5 == 0:
                    own = np.delete(own, 50)
            own[46:76] = line
            groups.append(g)
            rows.append(own[int(rng.integers(0, 20)): len(own) - int(rng.integers(0, 40))].astype("<u4"))
    mid = np.array([int(np.flatnonzero(r == np.uint32(line[15]))[0]) for r in rows])
    doc = np.array([i // 2 for i in range(len(rows))])  # A document may be there twice.
    ends = np.cumsum([len(r) for r in rows])
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    for y, low, high, x in passage_dedup.group_stretches(np.array(groups), doc, ends, mid, np.concatenate(rows), 46, 75):
        assert doc[x] < doc[y] and groups[x] == groups[y]
        got[y] |= set(range(low, high))
    for y in range(len(rows)):
        for x in range(y):
            if groups[x] == groups[y] and doc[x] < doc[y]:
                for low, high in passage_dedup.near_stretches(rows[x], rows[y], 46, 75):
                    want[y] |= {i for i in range(low, high) if abs(i - mid[y]) < 30}
    assert sum(map(bool, want.values())) > 40
    assert all(places <= got[y] for y, places in want.items())


def test_blocks_of_a_large_group_meet_each_other(spark):
    """A group dealt out in pairs of blocks gives what it gives in one."""
    line = prose(30, 95_000)
    texts = [f"{prose(70, 95_100 + i % 7)} {line} {prose(70, 95_200 + i % 5)}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    first = text.words(pa.array(texts[:1])).hashes
    grams = text.gram_hashes(first, 5)
    key = text.signed(text.mix(grams[80:81] ^ passage_dedup._SEEDS[0]))[0]
    at = [(i, int(key), len(texts), 0, 80) for i in range(len(texts))]
    windows = spark.createDataFrame(at, "doc_id long, key long, rows long, h int, c int")
    got = [
        {tuple(r)[:3] for r in spans.merged(passage_dedup.large_groups(docs, windows, 46, 75, 5, block)).select("doc_id", "low", "high").collect()}
        for block in (1000, 9)
    ]
    assert got[0] == got[1] and len(got[0]) > 40


def test_pairs_of_tiles_are_many_tasks(spark, monkeypatch):
    rows = [(i, [float(x) * (1 + 1e-6 * i * k) for k, x in enumerate(np.random.default_rng(i // 2).standard_normal(8))]) for i in range(400)]
    vectors, written, kept = spark.createDataFrame(rows, "vec_id long, embedding array<double>"), {}, embedding_dedup.stage

    def counted(df, label="stage"):
        if label == "tile-links":
            df = df.withColumn("task", F.spark_partition_id())
            df = written[label] = kept(df, label)
            return df.drop("task")
        return kept(df, label)

    monkeypatch.setattr(embedding_dedup, "stage", counted)
    got = embedding_dedup.near_duplicates(vectors, threshold=0.999, tile=20).collect()
    assert [r["n_links"] for r in got] == [1] * 400
    assert written["tile-links"].select("task").distinct().count() > 1


def test_links_of_a_tile_do_not_depend_on_the_step(monkeypatch):
    rng = np.random.default_rng(97_000)
    vectors = np.repeat(rng.standard_normal((30, 16)), 10, axis=0) + 0.05 * rng.standard_normal((300, 16))
    rows = pd.DataFrame({"rep": np.arange(300), "copies": rng.integers(1, 4, 300), "vec": [v.astype("<f8").tobytes() for v in vectors]})
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    close = (unit @ unit.T >= 0.9) & ~np.eye(300, dtype=bool)
    for step in (1 << 15, 7):
        monkeypatch.setattr(embedding_dedup, "PAIRS_AT_ONCE", step)
        reps, links, edges, computed = embedding_dedup.compare_tile(rows, None, 0.9, 4.0)
        assert (links == close @ rows["copies"].to_numpy()).all() and computed >= close.sum() / 2
        # Pairs that connect, fewer than rows.
        assert len(edges) == 300 - len({min(np.flatnonzero(c).tolist() + [i]) for i, c in enumerate(close)})
