"""One registered query for each corpus operator, over its whole table.

The operators keep their own general interface; a query here applies one with
production parameters and derives the result columns that are asked for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.llm import bpe, decontaminate, exact_dedup, hard_negatives, html_main, language, lm, near_dedup, pii, pivot_search, prefix_trie, quality, word_pieces
from orderstream.llm.common import fold, read_table, written

BPE_FILE = "word_bpe_49k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(spark, quality.document_statistics(read_table(spark, sf_dir, "documents")), "quality-statistics")
    scored = quality.score(stats, quality.fit(stats, read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id"), quality.HOLD_OUT_FOLDS) == quality.HELD_OUT, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    line = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(kind) for kind in pii.KINDS], F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learnt = F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(False))
    found = language.identify(docs, language.fit(docs.where(learnt)))
    return found.select("doc_id", (~learnt).alias("held_out"), "lang_pred", "score", "language")


def op4_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.fit(pages), ["page_id", "url"])


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learnt = F.coalesce(fold(F.col("doc_id"), 7) != 2, F.lit(False))
    scored = lm.score(docs, lm.train(docs.where(learnt)))
    return scored.select("doc_id", (~learnt).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op6_word_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pieces.count_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_report(read_table(spark, sf_dir, "documents"), keep="max")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(embeddings.select("vec_id", "embedding", label.alias("label")))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(read_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(prefix_trie.rebuilt_paths(read_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pii": op2_pii,
    "op3_language_id": op3_language_id,
    "op4_html_main": op4_html_main,
    "op5_language_model": op5_language_model,
    "op6_word_pieces": op6_word_pieces,
    "op7_minhash": op7_minhash,
    "op8_decontamination": op8_decontamination,
    "op9_bpe": op9_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_top_k": op12_top_k,
    "op13_prefix_trie": op13_prefix_trie,
}

#: DuckDB SQL by query; the operators without an entry are tested against brute force.
SQL = {
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op8_decontamination": r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM doc_words, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
found AS (SELECT doc_id, d.m, i, item_id FROM doc_windows d JOIN item_windows t ON d.m = t.m AND d.gram = t.gram),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_hard_negatives": """
WITH ints AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM ints a JOIN ints c ON c.vec_id IS DISTINCT FROM a.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 3""",
    "op12_top_k": """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 10""",
    "op13_prefix_trie": """
WITH crc_table AS (
  SELECT list_transform(generate_series(0, 255), lambda i: list_reduce(list_prepend(i, generate_series(1, 8)),
           lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
turns AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(x ORDER BY n) AS own FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                          lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 9 AS h
  FROM lists, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.own, 1, c.h), []), coalesce(list_slice(c.own, c.h + 1, len(c.own)), [])) AS s
  FROM heads c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (
  SELECT conv_id, d AS depth, list_slice(s, 1, d) AS p, list_slice(s, 1, d - 1) AS above, len(s) = d AS ends,
         CASE WHEN d > 0 THEN strlen(s[d].text) ELSE 0 END AS bytes
  FROM (SELECT conv_id, s, unnest(generate_series(0, len(s))) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, p),
linked AS (
  SELECT n.*, a.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.above = n.p) AS n_children
  FROM nodes n LEFT JOIN nodes a ON n.depth = a.depth + 1 AND n.above = a.p),
sums AS (
  SELECT n.depth, n.p, count(*) FILTER (s.n_children = 0) AS n_leaves, CAST(sum((s.n_convs - 1) * s.bytes) AS BIGINT) AS saved_tokens
  FROM linked n JOIN linked s ON s.depth >= n.depth AND list_slice(s.p, 1, n.depth) = n.p GROUP BY n.depth, n.p)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN sums USING (depth, p)""",
}
