"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm.bpe import bpe_encode
from candlelake.llm.common import fold, lower_ascii, table
from candlelake.llm.decontam import MARK, SIMILARITY, UNITS, contaminated
from candlelake.llm.exact_dedup import exact_dedup
from candlelake.llm.hard_negatives import hard_negatives
from candlelake.llm.html_extract import extract_text
from candlelake.llm.jaccard_join import jaccard_join
from candlelake.llm.langid import language_id
from candlelake.llm.lm_score import lm_scores
from candlelake.llm.merkle import build, proofs, record_digest
from candlelake.llm.packing import best_fit_packing
from candlelake.llm.quality import quality_scores
from candlelake.llm.substring_dedup import substring_dedup
from candlelake.llm.token_counts import token_counts

BYTE_BPE, PIECE_BPE, MULTI_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), lower_ascii(F.col("text")), keep="max")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = fold(F.col("doc_id"), 3)
    return quality_scores(docs, labels, learn=rest != 1, held_out=rest == 1)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=512)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = fold(F.col("doc_id"), 5)
    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), learn=rest != 1, held_out=rest == 1)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=2)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=50).drop("kept_text")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = fold(F.col("doc_id"), 4)
    return language_id(table(spark, sf_dir, "documents"), learn=rest != 2, held_out=rest == 2)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id"), label, F.col("embedding"), anchor=F.col("vec_id") % 50 == 0)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN
    coded = bpe_encode(table(spark, sf_dir, "documents"), path, pattern, decode=True)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = record_digest(*fields, F.col("text"))
    tampered = F.when(fold(F.col("doc_id"), 5) == 0, record_digest(*fields, lower_ascii(F.col("text")))).otherwise(leaf)
    every = proofs(build(docs, F.col("doc_id"), F.col("source"), leaf, presented=tampered))
    return every.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_lm_score": op5_lm_score,
    "op6_html_extraction": op6_html_extraction,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}

M = MARK
_CANONICAL = f"""trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
    '[\\s\\x0b\\x00-\\x20\\x{{a0}}]+', ' ', 'g'),
    '([\\p{{Ll}}\\p{{N}},;:] )(\\p{{Lu}}\\p{{Ll}})', '\\1{M}p\\2', 'g'),
    '(^|[^\\p{{L}}\\p{{N}}{M}])(\\p{{N}})', '\\1{M}n\\2', 'g'),
    '({M}n[^ ]* )({'|'.join(UNITS)})($|[^\\p{{L}}])', '\\1{M}u\\2\\3', 'g')),
    '[^\\p{{L}}\\p{{M}}\\p{{N}} {M}]+', '', 'g'), ' +', ' ', 'g'))"""

#: For benchmark items of at least five words.
DECONTAMINATION = f"""
    WITH lines AS (
        SELECT 'd' AS side, doc_id AS id, {_CANONICAL} AS line FROM documents
        UNION ALL SELECT 'b', item_id, {_CANONICAL} FROM benchmark
    ),
    readings AS (
        SELECT side, id, 0 AS reading, line FROM lines
        UNION ALL SELECT side, id, 1, replace(line, '{M}p', '') FROM lines WHERE contains(line, '{M}p')
    ),
    listed AS (
        SELECT side, id, reading, string_split(line, ' ') AS valued, string_split(regexp_replace(line, '({M}[npu])[^ ]*', '\\1', 'g'), ' ') AS words FROM readings
    ),
    starts AS (SELECT *, unnest(range(1, len(words) - 3)) AS pos FROM listed WHERE len(words) >= 5),
    wins AS (SELECT side, id, reading, pos, len(words) AS n, words[pos:pos + 4] AS win, valued[pos:pos + 4] AS slot FROM starts),
    known AS (SELECT * FROM wins WHERE side = 'b' AND len(list_filter(win, lambda x: NOT starts_with(x, '{M}'))) >= 2),
    totals AS (SELECT id, reading, count(DISTINCT win) AS total FROM known GROUP BY id, reading),
    met AS (
        SELECT d.id AS doc_id, k.id AS item_id, k.reading, k.win, k.slot AS i_slot, d.slot, (d.pos - k.pos) / (2.0 * k.n) AS shift
        FROM wins d JOIN known k ON d.side = 'd' AND d.win = k.win
    ),
    strips AS (SELECT *, 0 AS r, floor(shift) AS s FROM met UNION ALL SELECT *, 1, floor(shift + 0.5) FROM met),
    covered AS (SELECT doc_id, item_id, reading, r, s, count(DISTINCT win) AS n FROM strips GROUP BY ALL),
    pairs AS (SELECT doc_id, item_id, reading, r, s, unnest(i_slot) AS i, unnest(slot) AS v FROM strips),
    slots AS (
        SELECT doc_id, item_id, reading, r, s, count(DISTINCT (i, v)) AS n_pairs, count(DISTINCT i) AS n_slots, bool_and(i = v) AS same_values
        FROM pairs WHERE starts_with(i, '{M}') GROUP BY ALL
    )
    SELECT c.doc_id, c.item_id, max(c.n / t.total) AS coverage, CAST(max(coalesce(p.n_slots, 0)) AS INTEGER) AS n_slots, bool_or(coalesce(p.same_values, true)) AS same_values
    FROM covered c JOIN totals t ON t.id = c.item_id AND t.reading = c.reading
    LEFT JOIN slots p ON p.doc_id = c.doc_id AND p.item_id = c.item_id AND p.reading = c.reading AND p.r = c.r AND p.s = c.s
    WHERE c.n / t.total >= {SIMILARITY} AND coalesce(p.n_pairs, 0) = coalesce(p.n_slots, 0)
    GROUP BY c.doc_id, c.item_id
"""

def _split(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


REPEATS = f"""
    WITH d AS (SELECT doc_id, {_split("coalesce(text, '')")} AS w FROM documents),
    g AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50)),
    low AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
    gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS k FROM g JOIN low USING (g) WHERE m < doc_id),
    words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

#: All pairs that share a shingle; the operator may miss one at the threshold in a thousand.
SIMILAR = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_split("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END AS s FROM d
    ),
    copies AS (SELECT doc_id, s, CASE WHEN s IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS copy_of FROM sets),
    members AS (SELECT doc_id AS m, len(s) AS n, s FROM copies WHERE doc_id = copy_of AND s IS NOT NULL),
    grams AS (SELECT m, n, unnest(s) AS g FROM members),
    met AS (SELECT a.m AS a, b.m AS b, a.n + b.n AS total, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.m < b.m GROUP BY ALL),
    linked AS (SELECT a, b FROM met WHERE c >= 0.8 * (total - c) - 1e-9),
    links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
    reach AS (SELECT m AS node, m AS other FROM members UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
    classes AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT c.doc_id, coalesce(k.class_id, c.doc_id) AS class_id, c.copy_of, coalesce(n.n, 0) AS n_links
    FROM copies c LEFT JOIN classes k ON k.node = c.copy_of LEFT JOIN counted n ON n.a = c.copy_of
"""

_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _record(text: str) -> str:
    values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


def _tree(start: str, group: str, up: int) -> str:
    """CTEs {start}_1 to {start}_{up}: runs of 16 nodes, and the nodes of the next level; a group of one node stays as it is."""
    out = []
    for k in range(up):
        below = f"{start}_{k}"
        out.append(f"""{start}_r{k} AS (SELECT {group}, pos // 16 AS pos, (n + 15) // 16 AS m, n, list(h ORDER BY pos) AS hs FROM {below} GROUP BY {group}, pos // 16, n),
    {start}_{k + 1} AS (SELECT {group}, pos, m AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {start}_r{k})""")
    return ",\n    ".join(out)


def _climb(start: str, group: str, up: int, first: str, name: str) -> str:
    """CTEs {name}_1 to {name}_{up}: every leaf with its siblings and folded digest."""
    out = [f"{name}_0 AS ({first})"]
    for k in range(up):
        out.append(f"""{name}_{k + 1} AS (
        SELECT c.* REPLACE (c.pos // 16 AS pos, proof || array_to_string(hs[:c.pos % 16] || hs[c.pos % 16 + 2:], '') AS proof,
            CASE WHEN n > 1 THEN sha256(array_to_string(hs[:c.pos % 16], '') || fold || array_to_string(hs[c.pos % 16 + 2:], '')) ELSE fold END AS fold)
        FROM {name}_{k} c JOIN {start}_r{k} r ON r.pos = c.pos // 16 AND r.{group} IS NOT DISTINCT FROM c.{group})""")
    return ",\n    ".join(out)


#: For up to 16^6 documents a source and 16^3 sources.
MERKLE = f"""
    WITH leaves AS (
        SELECT doc_id, source, {_record("text")} AS leaf,
            CASE WHEN ({_CRC32}) % 5 = 0 THEN {_record("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_record("text")} END AS bad
        FROM documents
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
    s_0 AS (SELECT source, pos, n, leaf AS h FROM placed),
    {_tree("s", "source", 6)},
    t_0 AS (SELECT 0 AS top, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, h FROM s_6),
    {_tree("t", "top", 3)},
    {_climb("s", "source", 6, "SELECT doc_id, source, pos, leaf, bad AS fold, '' AS proof FROM placed", "c")},
    {_climb("t", "top", 3, "SELECT doc_id, 0 AS top, t_0.pos, leaf, t_0.h AS subroot, fold, proof FROM c_6 JOIN t_0 ON t_0.source IS NOT DISTINCT FROM c_6.source", "d")}
    SELECT doc_id, leaf, subroot, t_3.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t_3.h AS verified FROM d_3 CROSS JOIN t_3
"""

#: A full scan: all rows against all anchors.
NEGATIVES = """
    WITH v AS (
        SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.k, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ),
    best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS p FROM scored WHERE same QUALIFY p <= 5),
    hard AS (
        SELECT b.anchor_id, b.vec_id AS positive_id, row_number() OVER (PARTITION BY b.k, p ORDER BY n.score DESC, n.vec_id) AS rank, n.vec_id AS negative_id, b.score AS positive_score, n.score AS negative_score
        FROM best b JOIN scored n ON n.k = b.k AND NOT n.same AND 50 * b.score <= 100 * n.score AND 100 * n.score <= 95 * b.score
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3
"""

ORACLES: dict[str, str] = {
    "op11_hard_negatives": NEGATIVES,
    "op13_merkle_manifest": MERKLE,
    "op8_substring_dedup": REPEATS,
    "op9_jaccard_join": SIMILAR,
    "op3_decontamination": DECONTAMINATION,
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.body) AS text_sha256
        FROM d JOIN g ON d.body = g.body
    """,
}
