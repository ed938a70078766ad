"""The registered queries of the subpackage: thin uses of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import audit, bpe, chat, jaccard, packing, passages, pii, quality, resampling, sharding, substrings, topk, urls

URL_RULES: list[urls.Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: The registered queries' key; a user brings a secret one.
SURROGATE_KEY = "a key for the registered queries"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(read(spark, folder, "documents"), words=3, similarity=90)


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(read(spark, folder, "documents"), sharding.uniform_tree(24))


def op3_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").where(topk.usable("embedding")).where("vec_id IS NOT NULL")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("id"), topk.quantised("embedding").alias("v"))
    return topk.nearest(vectors, vectors.where("id % 20 = 0"), k=20)


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_bytes(read(spark, folder, "documents"), length=200)


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(read(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def word_ids():
    return packing.word_encoder(public_tokenizers.path("word_bpe_49k.json"), end=1)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), word_ids(), limits=(2048, 64, 2048))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(read(spark, folder, "documents"))


def op8_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymised(read(spark, folder, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_replaced")


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read(spark, folder, "pages"), URL_RULES)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    rules = quality.learn(quality.labelled_rows(documents, read(spark, folder, "labels")))
    return quality.judged(documents, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(read(spark, folder, "documents"), read(spark, folder, "benchmark"), percent=10, seed=2024)


#: A text that imitates the marks of chat templates, to be read back as it is.
IMITATION = "\\### Assistant: </turn> ok"


def op12_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(IMITATION).alias("text"),
    )
    turns = given.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digests(chat.formatted(turns))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    counts = audit.document_counts(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return audit.path_audit(counts)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_sharding, op3_exact_topk, op4_suffix_array_dedup, op5_byte_bpe, op6_packing,
        op7_substring_dedup, op8_pii_surrogates, op9_url_filters, op10_quality_rules,
        op11_importance_resampling, op12_chat_formatting, op13_filter_audit,
    )
}

LLM_ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
c AS (SELECT list_sort(s) AS s, min(doc_id) AS m FROM s WHERE len(s) > 0 GROUP BY 1),
g AS (SELECT m, len(s) AS n, unnest(s) AS g FROM c),
p AS (SELECT a.m AS a, b.m AS b, a.n AS x, b.n AS y, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.m < b.m GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 90 * (x + y - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT m AS a, m AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a AS m, min(b) AS component FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k.component, s.doc_id) AS component_id
FROM s LEFT JOIN c ON list_sort(s.s) = c.s LEFT JOIN k ON k.m = c.m""",
    "op3_exact_topk": """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 20 = 0 AND q.id <> c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_importance_resampling": r"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
texts AS (
  SELECT 0 AS side, doc_id, text, row_number() OVER () AS row_no FROM documents
  UNION ALL SELECT 1, NULL, text, row_number() OVER () FROM benchmark),
words AS (
  SELECT side, row_no, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts),
counted AS (SELECT side, row_no, w, count(*) AS n FROM words GROUP BY ALL),
bytes AS (
  SELECT w, list_transform(range(0, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)) AS b
  FROM (SELECT DISTINCT w FROM counted)),
buckets AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, x: xor(steps[xor(c & 255, x) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
sums AS (
  SELECT bucket, CAST(sum(n) FILTER (side = 0) AS DOUBLE) AS s, CAST(sum(n) FILTER (side = 1) AS DOUBLE) AS t
  FROM counted JOIN buckets USING (w) GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM sums) + 10000))
    / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM sums) + 10000)))) AS gain
  FROM sums),
weights AS (
  SELECT row_no, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM counted JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY 1),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (row_no) WHERE side = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed""",
    "op12_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
marks AS (
  SELECT *, role || chr(10) || text || chr(10) AS line,
    14 + length(role) + length(text) + (length(text) - length(replace(text, '\', '')))
      + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + list_sum(list_transform(string_split_regex(text, '[^#]+'), lambda h: greatest(length(h) - 2, 0))) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(line, '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marks GROUP BY 1""",
    "op13_filter_audit": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id AS e
  FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) THEN 'C' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
o AS (
  SELECT '' AS o UNION ALL
  SELECT o || c FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE length(o) < 5 AND NOT contains(o, c)),
s AS (
  SELECT o AS filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(o) = 5),
r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS c,
    sum(n) FILTER (translate(fails, substr(filter_order, 1, step), '') = fails) AS kept,
    sum(n) FILTER (contains(fails, substr(filter_order, step, 1)) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS removed,
    sum(n) FILTER (contains(fails, substr(filter_order, step, 1)) AND translate(fails, substr(filter_order, 1, step - 1), '') <> fails) AS redundant,
    sum(n) FILTER (fails = substr(filter_order, step, 1)) AS unique_fails,
    sum(good) FILTER (contains(fails, substr(filter_order, step, 1)) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS good_lost,
    sum(toxic) FILTER (contains(fails, substr(filter_order, step, 1)) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM r""",
}
