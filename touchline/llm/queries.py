"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import (
    exact_dedup,
    importance,
    line_dedup,
    mixing,
    ngram_join,
    piece_sampling,
    pii,
    quality_rules,
    sharding,
    spelling,
    token_counts,
    token_files,
    tree_bpe,
)
from touchline.llm.common import table, tokenizer

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_report(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.sample_pieces(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.tree_report(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_token_files, op3_sharding, op4_token_counts, op5_pii, op6_ngram_join, op7_piece_sampling,
        op8_quality_rules, op9_exact_dedup, op10_mixing, op11_importance, op12_tree_bpe, op13_spelling,
    )
}

#: crc32 in SQL: the table of the polynomial (CTE ``crc``), then a fold over the bytes of a string (its hexadecimal digits).
_CRC_TABLE = """crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i))"""


def _crc(text: str) -> str:
    """crc32 of a column where ``t`` is the table of ``crc``."""
    digits = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {digits}), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])))"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS s, generate_subscripts(ls, 1) AS ln FROM d),
f AS (SELECT doc_id, s, ln, row_number() OVER w AS i, len(regexp_extract_all(s, '\\S+')) AS n, sum(len(regexp_extract_all(s, '\\S+'))) OVER w AS c
  FROM l WHERE regexp_matches(s, '\\S') WINDOW w AS (PARTITION BY doc_id ORDER BY ln)),
p AS (SELECT a.doc_id, a.i, b.i AS j FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 9 AND b.c - a.c + a.n >= 10),
w AS (SELECT doc_id, i, min(j) AS j FROM p GROUP BY doc_id, i UNION SELECT doc_id, max(i), j FROM p GROUP BY doc_id, j),
t AS (SELECT w.doc_id, w.i, w.j, list(f.s ORDER BY f.i) AS t FROM w JOIN f ON f.doc_id = w.doc_id AND f.i BETWEEN w.i AND w.j GROUP BY ALL),
o AS (SELECT doc_id, i, j, min((doc_id, i)) OVER (PARTITION BY t) AS o FROM t),
r AS (SELECT DISTINCT doc_id, x AS i FROM (SELECT doc_id, i, j, o, unnest(range(i, j + 1)) AS x FROM o WHERE (doc_id, i) > o)
  WHERE NOT (o[1] = doc_id AND x < o[2] + (j - i + 1))),
n AS (SELECT doc_id, count(*) AS n_removed, sum(CAST(p IS DISTINCT FROM i - 1 AS BIGINT)) AS n_runs
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r) GROUP BY doc_id),
k AS (SELECT l.doc_id, string_agg(l.s, chr(10) ORDER BY l.ln) AS text FROM l LEFT JOIN f USING (doc_id, ln)
  LEFT JOIN r ON r.doc_id = f.doc_id AND r.i = f.i WHERE r.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, (SELECT count(*) FROM f WHERE f.doc_id = d.doc_id) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op9_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t""",
    "op11_importance": rf"""
WITH {_CRC_TABLE},
x AS (SELECT row_number() OVER () AS k, doc_id, {_LOWER} AS l FROM documents UNION ALL SELECT NULL, NULL, {_LOWER} FROM benchmark),
w AS (SELECT k, doc_id, regexp_extract_all(l, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM x),
f AS (SELECT k, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM w),
g AS (SELECT k, f, count(*) AS n FROM f GROUP BY ALL),
c AS (SELECT f, {_crc("f")} % 10000 AS b FROM (SELECT DISTINCT f FROM g), crc),
o AS (SELECT k, b, n FROM g JOIN c USING (f)),
m AS (SELECT b, sum(n) FILTER (k IS NOT NULL) AS s, sum(n) FILTER (k IS NULL) AS t FROM o GROUP BY b),
a AS (SELECT sum(s) AS ss, sum(t) AS tt FROM m),
e AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce(ss, 0) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(tt, 0) + 10000)::DOUBLE))) AS gain FROM m, a),
d AS (SELECT k, sum(n) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM o JOIN e USING (b) WHERE k IS NOT NULL GROUP BY k),
r AS (SELECT k, doc_id, len(ws) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN d USING (k) WHERE k IS NOT NULL),
z AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS p FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND p <= 25 * (SELECT count(*) FROM z WHERE n_words >= 20) // 100 THEN p END AS rank FROM q""",
    "op13_spelling": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT r, doc_id, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 7 GROUP BY ALL),
keyed AS (SELECT r, n, concat(doc_id, ':', r) AS k, t FROM runs, crc),
h AS (SELECT r, n, {_crc("k")} AS h FROM keyed),
c AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
b AS (SELECT word, count(*) AS n_near, max(m) AS m FROM p GROUP BY word),
f AS (SELECT word, n_near, m, (SELECT min(near) FROM p WHERE p.word = b.word AND p.m = b.m) AS near FROM b),
g AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM w LEFT JOIN f USING (word)),
s AS (SELECT word, word AS root, 0 AS hop FROM g UNION ALL SELECT s.word, g.form, hop + 1 FROM s JOIN g ON g.word = s.root WHERE g.form IS NOT NULL)
SELECT g.word, form, r.root, n, n_near, form_n FROM g JOIN (SELECT word, arg_max(root, hop) AS root FROM s GROUP BY word) r USING (word)""",
}
