"""One registered query per operator, on its whole table, and the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, html_extract, imatch, langid, mixing, phrases, quality, sharding, simhash, token_counts, toxicity, whitening
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    near = simhash.near_duplicates(rows, shingle=3, distance=2, seed=42)
    return near.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = table(spark, sf_dir, "documents").select("text")
    counted = token_counts.lengths(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, [])
    return token_counts.suffix_sums(token_counts.histogram(counted))


@_query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op4_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM t
"""


def held_out(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the fold that is not learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds)) == fold, F.lit(False))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(~held_out("doc_id", 3, 1)).select(F.col("doc_id").alias("id"), "text", "lang"))


@_query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text")
    return langid.predict(rows, language_model(docs), ["doc_id", "held_out"])


@_query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"), html_extract.fit(), ["page_id", "url"])


@_query
def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return imatch.neighbours_compared(rows).withColumnRenamed("id", "doc_id")


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(table(spark, sf_dir, "documents"), "doc_id", weights=(5, 2, 1), most=3).withColumnRenamed("id", "doc_id")


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    labels = table(spark, sf_dir, "labels").where(~out).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality.fit(docs.where(~out).select(F.col("doc_id").alias("id"), "text"), labels)
    scored = quality.scores(docs.select("doc_id", out.alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@_query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return sharding.shard_by_bytes(rows, shards=8).select(
        F.col("id").alias("doc_id"), "size", F.col("crc32").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@_query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])


@_query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    labels = table(spark, sf_dir, "labels").where(~out).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    model = toxicity.fit(docs.where(~out).select(F.col("doc_id").alias("id"), "text"), labels)
    scored = toxicity.passages(docs.select("doc_id", out.alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), whitening.integers(F.col("embedding")).alias("x"))
    return whitening.whitened(rows, most=16).withColumnRenamed("id", "vec_id")


@_query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top(phrases.collocations(phrases.frequent_phrases(table(spark, sf_dir, "documents"), least=100, longest=5)), 2000)


ORACLES["op13_phrases"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest([list_slice(ws, i, i + k - 1) for i in range(1, len(ws) - k + 2)]) AS ph FROM w, range(1, 6) s(k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, ph, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k AS m, ph, f AS a FROM f WHERE k > 1 AND f >= 100),
cut AS (SELECT c.lang, c.m, c.ph, c.a, s.k, list_slice(ph, 1, s.k) AS p1, list_slice(ph, s.k + 1, c.m) AS p2 FROM c, range(1, 5) s(k) WHERE s.k < c.m),
sc AS (SELECT cut.lang, cut.m, cut.ph, cut.a, cut.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * cut.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.ph = cut.p1 JOIN f y ON y.lang = cut.lang AND y.ph = cut.p2 JOIN t ON t.lang = cut.lang),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
sub AS (SELECT DISTINCT c.lang, list_slice(c.ph, i, i + n - 1) AS ph, c.a FROM c, range(1, 5) s(i), range(2, 5) z(n) WHERE n < c.m AND i + n - 1 <= c.m),
gone AS (SELECT lang, ph, max(a) AS most FROM sub GROUP BY lang, ph),
rest AS (SELECT b.* FROM b LEFT JOIN gone ON gone.lang = b.lang AND gone.ph = b.ph WHERE gone.most IS NULL OR gone.most < b.a),
o AS (SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score FROM rest)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o QUALIFY rank <= 2000
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
