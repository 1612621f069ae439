"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.llm.embedding_dedup import near_duplicates
from granary.llm.encoded_ids import encoded_summary, write_encoded
from granary.llm.merkle import manifest_check
from granary.llm.mixing import mix_digest
from granary.llm.ngram_join import jaccard_components
from granary.llm.packing import pack_documents
from granary.llm.passage_dedup import near_duplicate_passages
from granary.llm.quality import quality_scores
from granary.llm.repair import repair_digest
from granary.llm.suffix_dedup import repeated_passages
from granary.llm.token_counts import count_tokens
from granary.llm.top_k import top_k
from granary.llm.toxicity import toxicity_scores
from granary.staging import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_passages(_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op6_encoded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "encoded-ids")
    write_encoded(_table(spark, sf_dir, "documents"), path)
    return encoded_summary(spark, path)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_check(_table(spark, sf_dir, "documents"))


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_toxicity, op2_token_counts, op3_suffix_dedup, op4_passage_dedup, op5_ngram_join,
        op6_encoded_ids, op7_source_mix, op8_embedding_dedup, op9_packing, op10_top_k, op11_merkle_manifest,
        op12_line_quality, op13_conversation_repair,
    )
    return {f.__name__: f for f in named}


_SHINGLES = """
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
      THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b
  FROM items p JOIN items q ON p.x = q.x AND p.doc_id <> q.doc_id AND least(p.n, q.n) * 100 >= greatest(p.n, q.n) * 75
  GROUP BY p.doc_id, q.doc_id
  HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))),
reached AS (
  SELECT doc_id AS node, doc_id AS c FROM documents
  UNION SELECT b, c FROM reached JOIN links ON node = a)
"""

_VECTORS = """
vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v,
    embedding IS NOT NULL AND len(embedding) > 0
      AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) AS sound
  FROM embeddings)
"""


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, flatten(list_transform(
          range(1, len({text}) + 1), lambda i: [ascii(substr({text}, i, 1))::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda crc, byte: CASE WHEN xor(crc, byte) % 2 = 1 THEN xor(xor(crc, byte) >> 1, 3988292384::UBIGINT) ELSE xor(crc, byte) >> 1 END))"""


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(concat({}))".format(", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields))


#: Nodes of the next level, and the siblings of node i (from 1), of a level `nodes`.
_RUNS = "list_transform(range(1, len(nodes) + 1, 3), lambda i: sha256(array_to_string(nodes[i:i + 2], '')))"

_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS now
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) AS place FROM leaves),
levels AS (
  SELECT source, 0 AS height, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL SELECT source, height + 1, {_RUNS} FROM levels WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) AS place FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS height, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL SELECT height + 1, {_RUNS} FROM tops WHERE len(nodes) > 1),
walk AS (
  SELECT doc_id, source, leaf, 0 AS top, 0 AS height, place - 1 AS at, '' AS proof, now AS folded FROM placed
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf,
    CASE WHEN w.top = 0 AND len(l.nodes) = 1 THEN 1 ELSE w.top END,
    CASE WHEN w.top = 0 AND len(l.nodes) = 1 THEN 0 ELSE w.height + 1 END,
    CASE WHEN len(l.nodes) = 1 THEN s.place - 1 ELSE w.at // 3 END,
    CASE WHEN len(l.nodes) = 1 THEN w.proof ELSE concat(w.proof, array_to_string(l.nodes[w.at // 3 * 3 + 1:w.at], ''),
      array_to_string(l.nodes[w.at + 2:w.at // 3 * 3 + 3], '')) END,
    CASE WHEN len(l.nodes) = 1 THEN w.folded ELSE sha256(concat(array_to_string(l.nodes[w.at // 3 * 3 + 1:w.at], ''), w.folded,
      array_to_string(l.nodes[w.at + 2:w.at // 3 * 3 + 3], ''))) END
  FROM walk w
  JOIN (SELECT 0 AS top, source, height, nodes FROM levels UNION ALL SELECT 1, NULL, height, nodes FROM tops) l
    ON l.top = w.top AND l.height = w.height AND (w.top = 1 OR l.source IS NOT DISTINCT FROM w.source)
  JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source
  WHERE NOT (w.top = 1 AND len(l.nodes) = 1))
SELECT w.doc_id, w.leaf, s.subroot, t.nodes[1] AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,
  w.folded = t.nodes[1] AS verified
FROM walk w JOIN tops t ON w.top = 1 AND t.height = w.height AND len(t.nodes) = 1
JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source
"""

#: Best (cost, audit, repaired rows) per state after each row, over all edits of the row: no halving, no ranks.
_REPAIR = f"""
WITH RECURSIVE made AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM made WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text)), copy) AS place FROM damaged),
rows_ AS (
  SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed),
next_(state, role, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
-- Rows inserted before a row: none, one or two.
inserts AS (
  SELECT state, 0 AS cost, '' AS edits, []::VARCHAR[] AS added, state AS after FROM next_
  UNION ALL SELECT state, 3, 'I', [role || ':'], after FROM next_
  UNION ALL SELECT a.state, 6, 'II', [a.role || ':', b.role || ':'], b.after FROM next_ a JOIN next_ b ON b.state = a.after),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, 0 AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best
  FROM rows_ WHERE place = 1
  UNION ALL
  SELECT r.conv_id, r.place, e.after, min({{
      'cost': w.best.cost + i.cost + e.cost + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END,
      'audit': concat(w.best.audit, i.edits, e.letter),
      'lines': list_concat(list_concat(w.best.lines, i.added), CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'R' THEN [n.role || ':' || r.text]
        ELSE [r.role || ':' || r.text] END)}})
  FROM walk w
  JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.place = w.place + 1
  JOIN inserts i ON i.state = w.state
  JOIN next_ n ON n.state = i.after
  CROSS JOIN LATERAL (
    SELECT 'D' AS letter, 4 AS cost, n.state AS after
    UNION ALL SELECT 'R', 3, n.after WHERE r.fault IN ('fine', 'truncated')
    UNION ALL SELECT 'K', 0, n.after WHERE r.fault IN ('fine', 'truncated') AND r.initial = substr(n.role, 1, 1)
    UNION ALL SELECT 'K', 0, 1 WHERE r.fault IN ('fine', 'truncated') AND r.initial = 's' AND n.state = 0) e
  GROUP BY r.conv_id, r.place, e.after),
counts AS (
  SELECT conv_id, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (place > 1 AND concat(before, initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
done AS (
  SELECT w.conv_id, min({{
      'cost': w.best.cost + i.cost, 'audit': concat(w.best.audit, i.edits), 'lines': list_concat(w.best.lines, i.added)}}) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place
  JOIN inserts i ON i.state = w.state AND (i.after = 3 OR (i.after = 0 AND i.cost = 0))
  GROUP BY w.conv_id)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM g.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op13_conversation_repair": _REPAIR,
        "op11_merkle_manifest": _MERKLE,
        "op5_ngram_join": f"""
            WITH RECURSIVE {_SHINGLES}
            SELECT doc_id, len(s) AS n_shingles, component_id
            FROM sets JOIN (SELECT node, min(c) AS component_id FROM reached GROUP BY node) ON node = doc_id""",
        "op8_embedding_dedup": f"""
            WITH RECURSIVE {_VECTORS},
            links AS (
              SELECT p.vec_id AS a, q.vec_id AS b FROM vectors p JOIN vectors q ON p.vec_id <> q.vec_id
                AND p.sound AND q.sound AND list_dot_product(p.v, p.v) > 0 AND list_dot_product(q.v, q.v) > 0
                AND list_dot_product(p.v, q.v) >= 0.9 * sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(q.v, q.v))),
            reached AS (
              SELECT vec_id AS node, vec_id AS c FROM vectors
              UNION SELECT b, c FROM reached JOIN links ON node = a)
            SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
            FROM vectors JOIN (SELECT node, min(c) AS component_id FROM reached GROUP BY node) ON node = vec_id""",
        "op10_top_k": f"""
            WITH {_VECTORS},
            scaled AS (SELECT vec_id, list_transform(v, lambda x: floor(1024 * x)) AS v FROM vectors WHERE sound),
            scored AS (
              SELECT q.vec_id AS query_id, p.vec_id, list_dot_product(q.v, p.v)::BIGINT AS score
              FROM scaled q JOIN scaled p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id),
            ranked AS (
              SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
            SELECT * FROM ranked WHERE rank <= 10""",
    }
