"""A corpus pipeline of five of the operators, over a documents table.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of documents; extra
columns are carried along.

No stage can be stated in SQL as a whole (code lengths, fingerprints, keyed
permutations, merges), so ``ORACLE_SQL`` is None and the tests hold ``run``
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyhorizon.llm import bpe, exact_dedup, langid, mixing, simhash
from buyhorizon.llm.common import located, new_folder, rows_at, table, with_locators
from buyhorizon.llm.queries import language_model

WEIGHTS = (5, 2, 1)


def _whole(docs: DataFrame):
    """All columns as one, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language: those without a letter.

    The score is a posterior over the learned languages, so a low one marks a short
    text, not a foreign one, and rejects nothing. The model learns from the table's own
    labelled rows; where there is none, nothing can be judged and every row stays. Null
    and empty texts go, null ids and repeated rows stay, an empty table gives no rows;
    columns may have any name.
    """
    model = language_model(docs)
    if not model.langs:
        return docs
    found = langid.predict(docs.select(_whole(docs)), model, ["whole"], inner="text")
    return found.where(F.col("lang_pred") != langid.UND).select("whole.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the row with the smallest doc_id stays, a null one only where all are null; of
    repeated rows one stays. Null texts equal empty ones; an empty table gives no rows; columns may have any name."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints stays: the smallest doc_id (a null one only alone).

    Shingles of 3 words and 2 bits are those of the operator's contract. Null and empty texts have fingerprint zero and
    are linked with each other; of repeated rows one stays; an empty table gives no rows; columns may have any name."""
    docs = with_locators(docs)
    rows = located(docs, [F.col("doc_id").isNull().alias("null_id"), F.col("doc_id"), F.col("text")])
    near = simhash.near_duplicates(rows.select(F.struct("null_id", "doc_id", "file", "row").alias("id"), "text"), shingle=3, distance=2, seed=42)
    return rows_at(docs, near.where("id = component").select(F.col("id.file").alias("file"), F.col("id.row").alias("row")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1, ...: each row is a copy of a document with the words that the mix takes of it.

    ``text`` and ``n_chars`` are set anew. Null and empty texts take no words and go; a null source is one of its own;
    repeated rows are documents each; an empty table gives no rows; columns may have any name."""
    return mixing.mixed_documents(docs, "doc_id", WEIGHTS, most=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of the ids and the decoded text.

    These four columns replace incoming ones of their names. Null and empty texts have no ids; repeated rows are encoded
    each; an empty table gives no rows; other columns may have any name."""
    import public_tokenizers

    new = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    docs = docs.drop(*new)
    return bpe.round_trip(docs.select(_whole(docs)), public_tokenizers.path("word_bpe_49k.json"), ["whole"], with_ids=True, inner="text").select("whole.*", *new)


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies), ("mixing", mix), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir`` (or ``docs``); every stage's result is stored."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
