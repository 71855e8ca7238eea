"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, forest, licenses, negatives, packing, parity_join, quality, records, resample, slots, tiling, token_counts, warc
from .common import fresh_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``TOKENIZERS_DIR`` may name another folder."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@_query(
    "op1_near_copies",
    """
    WITH RECURSIVE e AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good FROM embeddings),
    l AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE a.good AND b.good AND list_cosine_similarity(a.v, b.v) >= 0.98),
    r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM e JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
    """,
)
def op1_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_copies(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard_by_slots(table(spark, sf_dir, "documents"), fresh_folder(spark, "slot_map"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


@_query("op4_token_records")
def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = records.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity_join.components_of(table(spark, sf_dir, "documents"), parity_join.Rule(size=4, part=85, whole=100))
    return found.select("doc_id", "n_shingles", "component_id")


@_query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"),
        F.array_join("label_list", ",").alias("labels"), "score",
    )


@_query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage")


@_query(
    "op9_warc",
    """
    WITH p AS (
        SELECT page_id, COALESCE(html, '') AS payload, octet_length(encode(COALESCE(html, ''))) AS payload_bytes,
               sha1(COALESCE(html, '')) AS payload_digest FROM pages),
    g AS (SELECT payload AS same, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN keep <> page_id THEN keep END AS refers_to
    FROM p LEFT JOIN g ON payload = same
    """,
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.write_archives(table(spark, sf_dir, "pages"))
    back = warc.read_archives(folder, index, keep_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@_query("op11_bpe")
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    spelled = F.array_join(F.col("ids").cast("array<string>"), ",")
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), "ids")
    back = bpe.decode(coded, path, keep=["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@_query(
    "op12_importance_resampling",
    """
    WITH table_of AS (  -- the 256 steps of CRC-32
        SELECT list(c ORDER BY i) AS steps FROM (
            SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) t(i))),
    words AS (
        SELECT doc_id, text, rn, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM (SELECT doc_id, COALESCE(text, '') AS text, row_number() OVER () AS rn FROM documents
              UNION ALL SELECT NULL, COALESCE(text, ''), NULL FROM benchmark)),
    feature AS (
        SELECT rn, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS f FROM words),
    bucket AS (
        SELECT f, xor(list_reduce([4294967295] || list_transform(range(0, len(h) // 2), lambda k: CAST('0x' || h[2 * k + 1 : 2 * k + 2] AS BIGINT)),
                  lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)), table_of),
    counts AS (
        SELECT bucket, count(rn) AS s, count(*) - count(rn) AS t FROM feature JOIN bucket USING (f) GROUP BY bucket),
    gain AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE)
               / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM counts),
    sums AS (
        SELECT rn, count(*) AS n, CAST(sum(g) AS BIGINT) AS total FROM feature JOIN bucket USING (f) JOIN gain USING (bucket)
        WHERE rn IS NOT NULL GROUP BY rn),
    scored AS (
        SELECT doc_id, len(w) AS n_words, COALESCE(n, 0) AS n_features,
               CASE WHEN n > 0 THEN CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ELSE 0 END AS weight,
               CAST('0x' || sha256('7:' || doc_id)[1:8] AS BIGINT) AS h
        FROM words LEFT JOIN sums USING (rn) WHERE rn IS NOT NULL),
    done AS (
        SELECT doc_id, n_words >= 20 AS enters, n_features, weight,
               weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM scored),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM done WHERE enters)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN place <= 25 * (SELECT count(*) FROM placed) // 100 THEN place END AS rank
    FROM done LEFT JOIN placed USING (doc_id)
    """,
)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@_query(
    "op13_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
    p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
    n AS (
        SELECT p.a, p.b, s.b AS neg, p.score AS ps, s.score AS ns,
               row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
        FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
    SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INTEGER) AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score
    FROM n WHERE rank <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    found = negatives.mine(vectors, F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
