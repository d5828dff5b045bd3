"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ann import search
from .common import scratch_path, table
from .decontam import decontaminate
from .divergence import audit
from .jaccard import join_components
from .langid import identify
from .mixing import mix
from .negatives import mine
from .packing import pack_documents
from .pii import extract
from .records import write, write_index
from .sharding import shard
from .suffix import remove_repeats
from .toxicity import score, train


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate(docs.select("doc_id", "text"), items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), scratch_path(spark, "slot-map"), 16)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_tokens(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "token-records")
    write(table(spark, sf_dir, "documents"), path, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return write_index(spark, path).withColumnRenamed("key", "doc_id").select("doc_id", "start", "n_tokens", "ids_crc32", "offset", "length")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, keep=["doc_id"]).select("doc_id", "held_out", "lang_pred", "score", "bits_per_char", "accepted")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents")).drop("contexts")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_pack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_shard": op2_shard,
    "op3_toxicity": op3_toxicity,
    "op4_jaccard": op4_jaccard,
    "op5_nearest": op5_nearest,
    "op6_tokens": op6_tokens,
    "op7_repeats": op7_repeats,
    "op8_language": op8_language,
    "op9_personal_data": op9_personal_data,
    "op10_mix": op10_mix,
    "op11_divergence": op11_divergence,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pack": op13_pack,
}

SQL: dict[str, str] = {
    "op11_divergence": """
WITH words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents)
),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
size AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY ALL),
pairs AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
    SELECT p.lang, p.source, k.term, coalesce(c.n, 0) AS n, s.v, sum(coalesce(c.n, 0)) OVER (PARTITION BY p.lang, p.source) AS total
    FROM pairs p JOIN kept k ON k.lang = p.lang JOIN size s ON s.lang = p.lang
    LEFT JOIN counts c ON c.lang = p.lang AND c.source = p.source AND c.term = k.term
),
priced AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (total + v) AS p FROM cells),
whole AS (
    SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
    FROM (SELECT lang, term, sum(n) AS n, max(v) AS v FROM cells GROUP BY ALL)
),
of_pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
    FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN priced y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
),
of_terms AS (
    SELECT x.lang, x.source, 'term' AS part, x.term AS item, (x.p - w.q) * (x.p - w.q) // w.q AS value
    FROM priced x JOIN whole w ON w.lang = x.lang AND w.term = x.term WHERE x.n > 0 AND x.p > w.q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM of_pairs UNION ALL FROM of_terms)
)
WHERE part = 'pair' OR rank <= 200
""",
    "op12_hard_negatives": """
WITH usable AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.id % 100 = 0 AND a.id <> b.id
),
liked AS (
    SELECT anchor, other AS positive, score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.other)::INTEGER AS rank,
    n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM liked p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""",
}
