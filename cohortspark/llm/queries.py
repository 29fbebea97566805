"""Registered queries of the corpus operators, with their DuckDB SQL where it can express them.

Every query applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, brown_lm, chat, exact_dedup, hard_negatives, license_scan, mixing, ngram_join, packing, pii, quality_rules,
               rule_ensemble, token_counts)
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file, found through its package."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "log_ppl", "lower", "upper")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = """
WITH sized AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
totals AS (SELECT key, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY key = 'n', key) - 1) % 3 + 1)::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap
  FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY cap / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM weighed),
goal AS (SELECT key, source_size, least(cap, w * max(lv) OVER ()) AS target FROM levels),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS times,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM goal),
ranked AS (
  SELECT s.*, sum(size) OVER (PARTITION BY key ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - sum(size) OVER (PARTITION BY key, h) AS before,
         sum(size) OVER (PARTITION BY key, h) AS own
  FROM sized s)
SELECT doc_id, size, source_size, target,
       (size * (times + CASE WHEN before < rest AND 2 * before + own <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked JOIN rests USING (key)
"""


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"))


def op4_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.jaccard_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


OP5_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
tokens AS (SELECT doc_id, unnest(s) AS t, len(s) AS n FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hostile = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    role.alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat.digest(chat.format_conversations(rows.unionByName(hostile)))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.best_license(table(spark, sf_dir, "documents"))


def _op7_sql() -> str:
    least = license_scan.LEAST_DICE
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(f"({quoted(name)}, {len(license_scan.template_places(text))}, "
                          f"[{', '.join(map(quoted, license_scan.template_bigrams(text)))}])" for name, text in license_scan.TEMPLATES)
    anchors = ", ".join(f"({quoted(name)}, {quoted(b)}, {place})" for name, text in license_scan.TEMPLATES
                        for b, place in license_scan.anchors(text))
    return f"""
WITH templates(name, length, own) AS (VALUES {templates}),
anchors(name, b, place) AS (VALUES {anchors}),
rows AS (SELECT doc_id, text, row_number() OVER () AS rid FROM documents),
words AS (
  SELECT rid, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM rows),
bigrams AS (SELECT rid, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS bs FROM words WHERE len(w) > 1),
marks AS (SELECT rid, unnest(bs) AS b, generate_subscripts(bs, 1) - 1 AS i FROM bigrams),
starts AS (SELECT DISTINCT m.rid, a.name, greatest(0, m.i - a.place) AS start FROM marks m JOIN anchors a USING (b)),
windows AS (
  SELECT rid, name, start, own, list_distinct(list_slice(bs, start + 1, start + length)) AS win
  FROM starts JOIN templates USING (name) JOIN bigrams USING (rid)),
matches AS (
  SELECT rid, name, start, 2.0::DOUBLE * len(list_intersect(win, own)) / (len(win) + len(own)) AS dice
  FROM windows WHERE len(win) BETWEEN len(own) * {least / (2 - least)!r} AND len(own) * {(2 - least) / least!r}),
best AS (
  SELECT *, row_number() OVER (PARTITION BY rid, name ORDER BY dice DESC, start) AS nth FROM matches WHERE dice >= {least!r}),
first AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, name, start) AS place, count(*) OVER (PARTITION BY rid) AS n
  FROM best WHERE nth = 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, name AS license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(start, -1)::BIGINT AS word
FROM rows d LEFT JOIN (SELECT * FROM first WHERE place = 1) f USING (rid)
"""


def op8_pack_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_buckets(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, row_number() OVER () AS rid,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM t WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST, rid)
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS r, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    counts = align.pair_counts(aligned, align.vocabulary_size(tokenizer_path("piece_bpe_32k.model")))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align.score_links(aligned, counts, digest).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_source_mix, op3_brown_lm, op4_boosted_pii, op5_ngram_jaccard, op6_chat_format, op7_license_scan,
                                   op8_pack_pieces, op9_rule_ensemble, op10_exact_dedup, op11_hard_negatives,
                                   op12_token_counts, op13_token_alignment)}
ORACLE = {"op2_source_mix": OP2_SQL, "op5_ngram_jaccard": OP5_SQL, "op7_license_scan": _op7_sql(), "op10_exact_dedup": OP10_SQL,
          "op11_hard_negatives": OP11_SQL}
