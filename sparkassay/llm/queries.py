"""Queries of the ten operators and the pipeline, with the SQL of those that it can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkassay.llm import (
    capfilters, chaining, fim, kdtree, mixing, packing, personal, records, resample, secrets, tagpaths,
    toxicity, weighted_minhash,
)
from sparkassay.llm.common import table
from sparkassay.session import scratch_path


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.best_fit_sequences(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset",
    )


def op6_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.documents.select("doc_id", "size", "source_size", "target", "taken")


def op10_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), folder)
    return records.read_records(spark, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op1_kdtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return kdtree.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.near_documents(table(spark, sf_dir, "documents"))


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bootstrapped_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(table(spark, sf_dir, "documents")).documents
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, personal.KINDS), F.sha2(personal.written(F.col("base")), 256).alias("base_sha256"),
        personal.written(personal.in_order(F.concat("base", "added"))).alias("spans"),
    )


def op9_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = tagpaths.extract_main_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


def op11_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("secret_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secrets.KINDS),
        F.sha2(secrets.written(secrets.in_order(F.col("secret_base"))), 256).alias("base_sha256"),
        secrets.written(secrets.in_order(F.concat("secret_base", "secret_added"))).alias("spans"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep_text=False
    )
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    plain = F.col("fim_form") == "plain"
    return docs.select(
        "doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n"), F.col("fim_form").alias("form"),
        F.when(~plain, F.col("fim_lo")).alias("prefix_chars"),
        F.when(~plain, F.col("fim_hi") - F.col("fim_lo")).alias("middle_chars"),
        F.sha2("fim_output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("fim_output"), F.col("fim_form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_kdtree_search": op1_kdtree_search,
    "op2_bootstrapped_contexts": op2_bootstrapped_contexts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_collinear_chaining": op4_collinear_chaining,
    "op5_weighted_minhash": op5_weighted_minhash,
    "op6_source_schedule": op6_source_schedule,
    "op7_weak_supervision": op7_weak_supervision,
    "op8_cap_filters": op8_cap_filters,
    "op9_tag_paths": op9_tag_paths,
    "op10_record_files": op10_record_files,
    "op11_secret_novelty": op11_secret_novelty,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', 'mix', doc_id::VARCHAR)) AS key
  FROM documents),
numbers AS (
  SELECT total, words, ceil(total / words)::BIGINT AS slots
  FROM (SELECT total, greatest(1, least(2048, total // 131072)) AS words
        FROM (SELECT coalesce(sum(size), 0)::BIGINT AS total FROM sized))),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source),
weighed AS (SELECT *, [1.0, 2.0, 3.0][(nth % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, nth
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY most / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT arg_min(level, most / weight) AS level FROM levels WHERE level * weight <= most),
targets AS (
  SELECT w.source, w.source_size, w.nth, least(most, coalesce(c.level * weight, most)) AS target
  FROM weighed w LEFT JOIN chosen c ON true),
bounds AS (
  SELECT *, floor(sum(target) OVER (ORDER BY nth) / sum(target) OVER () * 2147483648)::BIGINT AS high
  FROM targets WHERE target > 0),
stretches AS (
  SELECT *, coalesce(lag(high) OVER (ORDER BY nth), 0) AS low FROM bounds),
points AS (
  SELECT i AS slot, (i % 2147483648) * 1327217885 % 2147483648 AS point
  FROM (SELECT unnest(range((SELECT slots FROM numbers))) AS i)),
ranked AS (
  SELECT s.nth, ceil(s.source_size / n.words)::BIGINT AS blocks,
         row_number() OVER (PARTITION BY s.nth ORDER BY slot) - 1 AS rank
  FROM points p JOIN stretches s ON point >= low AND point < high, numbers n),
passes AS (
  SELECT nth, rank % blocks AS block, count(*) AS passes
  FROM ranked WHERE rank // blocks < 3 GROUP BY ALL),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.nth,
         coalesce(sum(size) OVER (PARTITION BY t.nth ORDER BY key, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT p.*, n.words, unnest(range(first // n.words, (first + size - 1) // n.words + 1)) AS block
  FROM placed p, numbers n WHERE size > 0),
used AS (
  SELECT doc_id, size, source_size, target,
         sum((least(first + size, (block + 1) * words) - greatest(first, block * words)) * coalesce(passes, 0))::BIGINT AS taken
  FROM pieces LEFT JOIN passes USING (nth, block)
  GROUP BY doc_id, size, source_size, target, nth, first)
SELECT * FROM used
UNION ALL SELECT doc_id, size, source_size, target, 0 FROM placed WHERE size = 0
"""

OP1_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""

OP8_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a),
roots AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(r.b, vec_id)) AS component_id,
       vec_id <= coalesce(r.b, vec_id) AS kept
FROM embeddings LEFT JOIN degrees d ON d.a = vec_id LEFT JOIN roots r ON r.a = vec_id
"""

OP13_SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hx
  FROM documents),
cut AS (
  SELECT *, least(('0x' || substr(hx, 1, 8))::UBIGINT % (n + 1), ('0x' || substr(hx, 9, 8))::UBIGINT % (n + 1))::BIGINT AS lo,
         greatest(('0x' || substr(hx, 1, 8))::UBIGINT % (n + 1), ('0x' || substr(hx, 9, 8))::UBIGINT % (n + 1))::BIGINT AS hi,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(hx, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(hx, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (SELECT *, substring(t, 1, lo) AS pre, substring(t, lo + 1, hi - lo) AS mid, substring(t, hi + 1) AS suf FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op1_kdtree_search": OP1_SQL, "op6_source_schedule": OP6_SQL, "op8_cap_filters": OP8_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
