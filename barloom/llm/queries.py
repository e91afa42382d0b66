"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, embedding_dedup, fill_in_middle, importance_resampling, jaccard_join, language_id, license_scan, media, mixing, packing, substring_dedup, token_counts, toxicity


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_docs(spark, sf_dir)).drop("blocks")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir), "byte_bpe_50k.json", limit=1024)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(_docs(spark, sf_dir), width=50).drop("kept_text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), size=1024, tokenizer="byte_bpe_50k.json", end_id=0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_docs(spark, sf_dir), weights=(3.0, 1.0, 2.0), share=1.5, most=2.0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(_docs(spark, sf_dir), labels, threshold=0.3).drop("segments")


def op6_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images rendered from all embeddings; those with an id divisible by 50, cropped and brightened, are the queries."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return media.matching_images(media.rendered(vectors.where("vec_id % 50 = 0"), edit=True), media.rendered(vectors))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.95)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_docs(spark, sf_dir)).drop("spans")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_docs(spark, sf_dir), k=3, percent=90)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = importance_resampling.resampled(_docs(spark, sf_dir), target, percent=10, least_words=20, lengths=(1, 1), buckets=10_000, seed=2024)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(_docs(spark, sf_dir), seed=1, plain_from=90, spm_below=20, texts=False)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(_docs(spark, sf_dir), items, width=10).drop("items", "near_items")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_media_copies": op6_media_copies,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_language_id": op8_language_id,
    "op10_packing": op10_packing,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_decontamination": op13_decontamination,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
# CRC-32 by its table of 256 values, which is made by its polynomial, over the bytes of each distinct word
_CRC = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
buckets AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM (SELECT word FROM doc_words UNION ALL SELECT word FROM target_words)), crc_table)"""

ORACLE_SQL: dict[str, str] = {
    "op11_importance_resampling": f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
doc_words AS MATERIALIZED (SELECT id, word, count(*) AS n FROM (SELECT id, unnest(w) AS word FROM d) GROUP BY ALL), target_words AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL), {_CRC},
s AS (SELECT bucket, sum(n) AS n FROM doc_words JOIN buckets USING (word) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS n FROM target_words JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * ((SELECT sum(n) FROM s)::DOUBLE + 10000) / ((s.n::DOUBLE + 1) * (coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
sums AS (SELECT id, sum(n * gain)::BIGINT AS total FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY id),
weighed AS (SELECT id, doc_id, len(w) AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE (total - ((total % len(w)) + len(w)) % len(w)) // len(w) END AS weight FROM d LEFT JOIN sums USING (id)),
scored AS (SELECT id, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed),
able AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN rank <= 10 * (SELECT count(*) FROM able) // 100 THEN rank END AS rank FROM scored LEFT JOIN able USING (id)""",
    "op12_fill_in_middle": """WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
n AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2, ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM h),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
    "op13_decontamination": f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents), i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
p AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 10) AS k, unnest(list_transform(range(greatest(len(w) - 10, 0) + 1), lambda s: array_to_string(w[s + 1 : s + 10], ' '))) AS phrase FROM i WHERE len(w) > 0),
t AS (SELECT id, word, pos FROM (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d)),
g AS (SELECT id, pos, k, string_agg(word, ' ') OVER (PARTITION BY id, k ORDER BY pos ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING) AS phrase FROM t, (SELECT DISTINCT k FROM p)),
m AS MATERIALIZED (SELECT DISTINCT id, pos, k, item FROM g JOIN p USING (k, phrase)),
hits AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(pos, pos + k)) AS place FROM m) GROUP BY id),
found AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM m) GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hits USING (id) LEFT JOIN found USING (id)""",
}
