"""Queries over the driver's tables, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.llm import (
    decontaminate, filter_audit, fingerprints, html_text, line_dedup, near_dup, sentencepiece_bpe, substring_dedup,
    token_counts, token_files, toxicity, vector_codes, warc,
)
from haulmark.llm.common import table
from haulmark.queries.base import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: DuckDB's way to say "A-Z in lower case" and "ASCII white space".
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` and its SQL."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def piece_model() -> str:
    """Path of the public SentencePiece model, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_substring_dedup", r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
least_of AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN least_of USING (h) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
judged AS (SELECT w.doc_id, w.i, word, g.i IS NOT NULL AS gone FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i)
SELECT d.doc_id, count(j.i) AS n_words, count(j.i) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY j.i) FILTER (NOT gone), '')) AS kept_sha256
FROM docs d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, i, line, {_LOWER.format(f"trim(line, {_BLANKS})")} AS k
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
held AS (SELECT k, min(doc_id) AS first, max(doc_id) AS last FROM lines WHERE length(k) >= 10 GROUP BY k),
judged AS (SELECT l.*, coalesce(first < last AND doc_id > first, false) AS gone FROM lines l LEFT JOIN held h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op5_near_dup", rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(b, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of m ON m.a = d.doc_id""")
def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@F.pandas_udf(T.StringType())
def ids_sha256(ids: pd.Series) -> pd.Series:
    return ids.map(lambda row: hashlib.sha256(np.asarray(row).astype("<u4").tobytes()).hexdigest())


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), piece_model())
    decoded = sentencepiece_bpe.decode(encoded, piece_model())
    return decoded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
        ids_sha256("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(F.col("id").alias("doc_id"), "p_quality", "p_toxic", F.col("rejected").alias("toxic"))


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                     part_chars=decontaminate.PART_CHARS)
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").alias("start_char"),
                        F.col("stop").alias("end_char"), "edits")


@query("op10_html_text")
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    extracted = html_text.extract_text(pages, html_text.page_weights(pages))
    return extracted.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), piece_model())
    return counted.select(F.col("id").alias("doc_id"), "n_tokens", "n_words", "score")


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))
    return compared.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


#: SHA-1 in base 32: eight characters for each ten hexadecimal digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {10 * block + 1}, 10))::BIGINT >> {35 - 5 * i}) & 31)::INT, 1)"
    for block in range(4) for i in range(8)
)


@query("op4_warc", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT h, max(page_id) AS holder FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < holder THEN holder END AS refers_to
FROM p JOIN last USING (h)""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = warc.write_archives(table(spark, sf_dir, "pages"))
    index = warc.capture_index(runs)
    # Both sides grow with the pages, whatever the planner takes them for.
    records = warc.read_archives(runs).drop("payload", "page_id", "captured").hint("merge")
    return index.join(records, ["file", "start"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def byte_model() -> str:
    """Path of the public byte-level BPE model, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), byte_model())
    return token_files.read_token_files(files, ids=False).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op12_filter_audit", r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least_of AS (SELECT t, min(doc_id) AS least FROM docs GROUP BY t),
marks AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
          FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask
  FROM docs JOIN least_of USING (t) LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
steps(filter_order, step, bit, before) AS (
  SELECT l, 1, 1 << (ascii(l) - 65), 0 FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l)
  UNION ALL
  SELECT filter_order || l, step + 1, 1 << (ascii(l) - 65), before | bit
  FROM steps, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(filter_order, l)),
orders AS (SELECT o.filter_order, s.step, s.bit, s.before FROM steps o JOIN steps s ON starts_with(o.filter_order, s.filter_order)
           WHERE length(o.filter_order) = 5),
hits AS (SELECT part, filter_order, step, mask = bit AS only_this, (mask & bit) <> 0 AS fails, (mask & before) <> 0 AS gone,
                n, good, toxic, bit_count(mask) AS k FROM counts, orders)
SELECT part, filter_order, step::INT AS step,
       coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (only_this), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(k, 1)) FILTER (fails), 0)::BIGINT AS shapley
FROM hits GROUP BY part, filter_order, step""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _round_sql(i: int) -> str:
    """One round of assignment: squared distances, the nearest entry, and the entries it moves to."""
    return f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, j, min(d * 64 + e) AS best FROM (
    SELECT vec_id, p.j, e, list_sum(list_transform(list_zip(a, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN c{i} ON p.j = c{i}.j) GROUP BY vec_id, j)"""


def _moved_sql(i: int) -> str:
    return f"""
m{i} AS (SELECT j, e, k, sum(x) AS s, count(*) AS n FROM (
    SELECT a{i}.j, best % 64 AS e, unnest(a) AS x, generate_subscripts(a, 1) AS k FROM a{i} JOIN parts p ON p.vec_id = a{i}.vec_id AND p.j = a{i}.j)
  GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.j, c{i}.e, coalesce(moved, c) AS c FROM c{i} LEFT JOIN (
    SELECT j, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY k) AS moved FROM m{i} GROUP BY j, e) m ON m.j = c{i}.j AND m.e = c{i}.e)"""


@query("op13_vector_codes", f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, j, v[j * w + 1:(j + 1) * w] AS a FROM (SELECT vec_id, v, len(v) // 16 AS w, unnest(range(16)) AS j FROM kept)),
c0 AS MATERIALIZED (
  SELECT j, e, a AS c FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
                                       ORDER BY vec_id LIMIT 64) USING (vec_id)),
{_round_sql(0)},{_moved_sql(0)},{_round_sql(1)},{_moved_sql(1)},{_round_sql(2)},
coded AS (SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY j) AS code, sum(best // 64)::BIGINT AS error
          FROM a2 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY j, e, k)) AS h
         FROM (SELECT j, e, unnest(c) AS x, generate_subscripts(c, 1) AS k FROM c2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), book""")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")
