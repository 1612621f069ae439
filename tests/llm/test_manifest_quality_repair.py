"""Merkle manifest, line quality and conversation repair against brute force, and on awkward rows."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.llm import merkle, quality, repair

_rng = np.random.default_rng(11)
DOCS = "doc_id long, source string, lang string, n_chars long, text string, node string, place int, path string"


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i: i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, i):
    found = []
    for level in levels[:-1]:
        a = i // 3 * 3
        found.append(("".join(level[a:i]), "".join(level[i + 1: a + 3])))
        i //= 3
    return found


def plain_manifest(rows):
    """One row per document, with every level of every tree kept."""
    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    trees = {}
    for source, held in by_source.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[source] = held, plain_tree([plain_leaf(r) for r in held])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = plain_tree([trees[s][1][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        held, levels = trees[source]
        for i, row in enumerate(held):
            path, now = plain_path(levels, i) + plain_path(top, k), row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = (*row[:4], row[4].replace("\n", ""))
            node = plain_leaf(now)
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], levels[0][i], levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def by_text(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 28, 1200])
def test_manifest_equals_whole_trees(spark, n):
    rows = [
        (i if i % 7 else None, None if i % 50 == 9 else "hot" if i % 3 else f"s{i % 11}é", "en" if i % 4 else None, i, "a\nb" * (i % 5) if i % 6 else None)
        for i in range(n)
    ]
    rows += rows[:1] * 4
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS).repartition(5)
    got = merkle.manifest_check(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert by_text(got.collect()) == by_text(plain_manifest(rows))


def test_manifest_keeps_every_third_level_only(spark, tmp_path):
    rows = [(i, "s", "en", 1, f"t{i}", "x", 1, "y") for i in range(800)]
    path = f"file://{tmp_path}/manifest"
    found = merkle.write_manifest(spark.createDataFrame(rows, DOCS), path)
    assert [level.count() for level in found.sources] == [800, 30, 2, 1]
    assert found.root == spark.read.parquet(f"{path}/top-0").first()["node"]
    held = merkle.proofs(found).select("node", F.size("path").alias("n"), merkle.folded(F.col("node")).alias("root")).collect()
    assert {(r["n"], r["root"]) for r in held} == {(7, found.root)}


def test_marginals_and_slope_equal_enumeration():
    sizes = [1, 0, 4, 2, 7]
    first = np.concatenate(([0], np.cumsum(sizes)))
    logits, good, bad = _rng.normal(size=first[-1]), 0.7, -0.4
    marginal, total, pairs = quality.chain(logits, first, good, bad)
    for k, (a, z) in enumerate(zip(first[:-1], first[1:])):
        weights, ones, both, none = 0.0, np.zeros(z - a), 0.0, 0.0
        for labels in itertools.product((0, 1), repeat=int(z - a)):
            gg = sum(x and y for x, y in zip(labels, labels[1:]))
            bb = sum(not x and not y for x, y in zip(labels, labels[1:]))
            w = np.exp(sum(e for e, y in zip(logits[a:z], labels) if y) + good * gg + bad * bb)
            weights, both, none = weights + w, both + w * gg, none + w * bb
            ones += w * np.array(labels)
        if z > a:
            assert np.isclose(total[k], np.log(weights))
            assert np.allclose(marginal[a:z], ones / weights)
            assert np.allclose(pairs[k], (both / weights, none / weights))
    features, held = _rng.normal(size=(int(first[-1]), 5)), np.concatenate(([0], first[1:][np.diff(first) > 0]))
    labels = np.array([True, False, False, True])
    at = _rng.normal(size=8) * 0.3
    _, slope = quality.loss_and_gradient(at, features, held, labels)
    for i in range(8):
        step = np.zeros(8)
        step[i] = 1e-5
        high, low = (quality.loss_and_gradient(at + s, features, held, labels)[0] for s in (step, -step))
        assert np.isclose((high - low) / 2e-5, slope[i], atol=1e-6)


def test_lines_and_their_features():
    values = ["A good line.\n\nTHE !!! x x x\n", None, "", " \n\t", "one\ntwo two\ntwo two", "é" * 9]
    found = quality.lines(pa.array(values))
    assert np.diff(found.first).tolist() == [2, 0, 0, 0, 3, 1]
    cut = [values[t].encode()[a:z].decode() for t, a, z in zip(found.text, found.low, found.high)]
    assert cut == ["A good line.", "THE !!! x x x", "one", "two two", "two two", "é" * 9]
    names = quality.FEATURES
    assert found.features[1, names.index("repeated")] == 2 / 5 and found.features[0, names.index("repeated")] == 0
    assert found.features[:, -1].tolist() == [0, 0, 0, 0, 1, 0]
    assert np.array_equal(found.features[0, len(names): 2 * len(names)], np.zeros(len(names)))
    assert np.array_equal(found.features[1, len(names): 2 * len(names)], found.features[0, : len(names)])
    # A text scores the same alone and among others.
    model = quality.train(pa.array(["fine words here.\nmore of them."] * 20 + ["x x x x\ny y y y"] * 20), np.arange(40) < 20)
    together = quality.document_scores(model, pa.array(values))
    assert np.allclose(together, [quality.document_scores(model, pa.array([v]))[0] for v in values])
    assert together[1] == together[2] == together[3] == model.prior


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    wrong = {r["doc_id"] for r in got.where("held_out").collect() if r["held_out"] != (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)}
    assert not wrong
    held = got.where("held_out").join(labels, "doc_id").selectExpr("avg(int(predicted = quality)) AS right", "count(*) AS n").first()
    assert held["n"] > 60 and held["right"] >= 0.95
    # Labels of held-out rows change nothing.
    turned = labels.withColumn("quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.quality_scores(docs, turned).exceptAll(got).count() == 0


def test_quality_of_awkward_rows(spark):
    schema = "doc_id long, text string, score double, quality int"
    long = ("good words in a line.\n" * 30_000)
    rows = [(1, None, 1.0, 1), (2, "", 1.0, 1), (2, "a b c.", 1.0, 1), (2, "a b c.", 1.0, 1), (None, "no id", 1.0, 1), (3, long, 1.0, 1), (4, "\n\n", 1.0, 0)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.quality_scores(docs, none).collect()
    assert len(got) == len(rows) and {r["score"] for r in got} == {0.5}
    odd = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7), (3, 1), (4, 0), (4, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, odd).count() == len(rows)
    assert quality.quality_scores(docs.limit(0), odd).collect() == []
    model = quality.train(pa.array(["fine words here.\nmore of them."] * 20 + ["x x x x\ny y y y"] * 20), np.arange(40) < 20)
    held = quality.label_lines(docs, model).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in held} == {None: 1, 2: 2, 3: 30_000}
    with pytest.raises(ValueError):
        quality.score(docs, model)


AFTER = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"s": (1, "system"), "u": (2, "user"), "a": (3, "assistant")}


def plain_repair(rows):
    """Best (cost, audit, lines) by keeping whole texts for each state, over rows (role, text)."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def grown(states):
        for _ in range(2):
            for state, (cost, audit, made) in list(states.items()):
                to, name = NAMES[AFTER[state]]
                found = (cost + 3, audit + "I", [*made, f"{name}:"])
                states[to] = min(states.get(to, found), found)
        return states

    states = {0: (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        after = {}
        # Insertions are tried on all ways into a state, as the least audit may come by any of them.
        options = []
        for state, held in states.items():
            at, (cost, audit, made) = state, held
            for k in range(3):
                options.append((at, cost + 3 * k, audit + "I" * k, made))
                to, name = NAMES[AFTER[at]]
                at, made = to, [*made, f"{name}:"]
        for state, cost, audit, made in options:
            steps = [(state, 4, "D", None)]
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                to, name = NAMES[AFTER[state]]
                steps.append((to, 3 + extra, "R", f"{name}:{text}"))
                if role[:1] == AFTER[state] or (role[:1] == "s" and state == 0):
                    steps.append((NAMES[role[0]][0], extra, "K", f"{role}:{text}"))
            for to, more, letter, line in steps:
                found = (cost + more, audit + letter, made if line is None else [*made, line])
                after[to] = min(after.get(to, found), found)
        states = after
    ends = []
    for state, (cost, audit, made) in states.items():
        tail = {0: [], 1: ["user:", "assistant:"], 2: ["assistant:"], 3: []}[state]
        ends.append((cost + 3 * len(tail), audit + "I" * len(tail), made + tail))
    cost, audit, made = min(ends)
    pairs = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, sha("\n".join(made)))


def plain_damage(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        made += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return made


def plain_digest(rows):
    held = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in plain_damage(rows):
        held[conv].append((turn, role, text))
    out = []
    for conv, talk in held.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        turns = {t for t, _, _ in talk if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *plain_repair([(r, t) for _, r, t in talk])) if talk else (conv, 0, 0, 0, 0, 0, 0, "", sha("")))
    return by_text(out)


def talks(n, longest, roles, seed):
    rng = np.random.default_rng(seed)
    texts = ["Yes.", "No", "Well?  \n", "", " \t", "Good!", "line one.\nline two", None, *[f"text {i}." for i in range(40)]]
    rows = []
    for conv in range(n):
        for turn in range(int(rng.integers(1, longest + 1))):
            rows.append((conv, turn + int(rng.integers(0, 3)), str(rng.choice(roles)), texts[rng.integers(0, len(texts))]))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_repair_equals_brute_force(spark):
    rows = talks(150, 9, ["system", "user", "assistant", "tool", "User", ""], 1) + [
        (None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b."), (900, None, "user", "x."), (900, None, "assistant", "y."),
    ]
    rows += rows[:20]
    talk = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", audit string, cost int").repartition(6)
    assert by_text(repair.repair_digest(talk).collect()) == plain_digest(rows)
    assert repair.repair_digest(talk.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [2, 5])
def test_long_conversations_in_parts(spark, chunk):
    rows = talks(3, 120, ["user", "assistant", "system"], 2) + [(50, i, "user", f"hot {i}") for i in range(130)]
    talk = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert by_text(repair.repair_digest(talk, chunk).collect()) == plain_digest(rows)


def test_matrices_of_runs_equal_all_edits():
    """Costs and ranks of a run's matrix against all edit texts, written out."""
    for _ in range(60):
        codes = [4 * int(_rng.integers(0, 4)) + int(_rng.integers(0, 4)) for _ in range(int(_rng.integers(1, 5)))]
        found = repair.run_matrix([repair.row_matrix(c) for c in codes])
        for start in range(4):
            held = {start: (0, "")}
            for code in codes:
                after = {}
                for (p, q), (cost, text) in repair.row_steps(code).items():
                    if p in held:
                        step = (held[p][0] + cost, held[p][1] + text)
                        after[q] = min(after.get(q, step), step)
                held = after
            assert {q: c for q, (c, _) in held.items()} == {q: c for q, (c, _) in enumerate(found[start]) if c < 1 << 59}
            order = sorted(held, key=lambda q: held[q][1])
            assert [found[start][q][1] for q in order] == list(range(len(order)))
            for q in held:
                assert repair.edits(bytes(codes), start, q) == held[q]


def test_repaired_rows_read_well(spark):
    rows = talks(60, 8, ["system", "user", "assistant", "tool"], 5)
    got = collections.defaultdict(list)
    for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect():
        got[r["conv_id"]].append((r["edit"], r["role"]))
    assert set(got) == {r[0] for r in rows}
    for steps in got.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for edit, role in steps if edit != "D"))
    assert sum(edit != "I" for steps in got.values() for edit, _ in steps) == len(rows)
