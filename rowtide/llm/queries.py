"""The registered queries of the ``llm`` operators.

Each applies one operator with production parameters to its whole table and
derives the columns of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents (3-word shingles, up to 3 bits)."""
    from rowtide.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and decision-list verdict of all documents."""
    from rowtide.llm.quality_rules import judge

    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of a quarter of the ids are held out."""
    from rowtide.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    found = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    from rowtide.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    from rowtide.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    import public_tokenizers

    from rowtide.llm.token_files import id_dtype, read, write

    path = public_tokenizers.path("byte_bpe_50k.json")
    return read(write(table(spark, sf_dir, "documents"), path, end_id=0), id_dtype(path))


@query
def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents."""
    from rowtide.llm.decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, indexed, and read back through the index."""
    from rowtide.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).drop("target_uri")


ORACLES["op1_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM f
"""


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from rowtide.llm.pii import BASE, listed, spans

    found = spans(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind, _ in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings removed from all documents."""
    from rowtide.llm.substrings import deduplicate

    return deduplicate(table(spark, sf_dir, "documents"), length=50)


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled uniformly into 16 shards; row counts are at most one apart."""
    from rowtide.llm.sharding import shuffle

    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    size = (F.octet_length(body) + 1).cast("long").alias("size")
    docs = table(spark, sf_dir, "documents").select("doc_id", size, F.crc32(body).alias("text_crc32"))
    return shuffle(docs, shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    from rowtide.llm.negatives import hard_negatives, quantized

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantized(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM e a, e r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    from rowtide.llm.spelling import variants, vocabulary

    return variants(vocabulary(table(spark, sf_dir, "documents")))


ORACLES["op11_spelling"] = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
  ) GROUP BY ALL
), hashed AS (
  SELECT run, k, xor(list_reduce(flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM runs, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(k)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3
), plain AS ( -- levenshtein() counts bytes: one byte for each letter
  SELECT *, translate(word, list_aggregate(list_transform(range(192, 256), lambda i: chr(i::INTEGER)), 'string_agg', ''),
    list_aggregate(list_transform(range(33, 97), lambda i: chr(i::INTEGER)), 'string_agg', '')) AS p FROM words
), near AS (
  SELECT DISTINCT word, n, other, other_n FROM (
    SELECT w.word, w.n, v.word AS other, v.n AS other_n, w.p, v.p AS q FROM plain w JOIN plain v ON left(w.p, 2) = left(v.p, 2) AND abs(length(w.p) - length(v.p)) <= 1
    UNION ALL
    SELECT w.word, w.n, v.word, v.n, w.p, v.p FROM plain w JOIN plain v ON right(w.p, 2) = right(v.p, 2) AND abs(length(w.p) - length(v.p)) <= 1
  ) WHERE levenshtein(p, q) = 1
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS form_n, arg_min(other, {'a': -other_n, 'b': other}) AS form FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), up AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT up.word, f.form FROM up JOIN formed f ON f.word = up.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, u.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT up.word, up.root FROM up JOIN formed g ON g.word = up.root WHERE g.form IS NULL) u USING (word)
"""
