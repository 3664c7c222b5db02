"""Exact deduplication against a brute-force version, on awkward rows."""

import hashlib
import re

from pyspark.sql import functions as F

from buyhorizon.llm import exact_dedup as D
from buyhorizon.llm.common import new_folder

SCHEMA = "doc_id long, text string, file string, first string"  # file and first clash with internal names


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    by = {}
    for doc_id, text, *_ in rows:
        by.setdefault(norm(text), []).append(doc_id)
    smallest = {t: min((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    return {(i, smallest[norm(t)], len(by[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, *_ in rows}


ROWS = [(5, "a  b", "x", None), (3, "a\tb", "y", "q"), (9, "A b", None, ""), (7, None, "", ""), (8, "", "", ""), (1, " ", "", ""),
        (2, "x " * 50_000, "", ""), (4, "x " * 50_000, "", ""), (3, "a\tb", "y", "q"), (None, "a b", "", ""), (None, "lone", "", "")]


def test_matches_brute_force(spark):
    got = D.exact_groups(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(got) == len(ROWS)
    assert {(r.id, r.keep_id, r.group_size, r.digest) for r in got} == brute(ROWS)
    assert sum(r.kept for r in got) == len({norm(r[1]) for r in ROWS})


def test_equal_digests_of_different_texts_are_told_apart(spark):
    weak = lambda text: F.pmod(F.crc32(text), F.lit(2)).cast("string")
    rows = [r for r in ROWS if r[0] is not None]
    got = D.exact_groups(spark.createDataFrame(rows, SCHEMA), digest=weak).collect()
    assert {(r.id, r.keep_id, r.group_size) for r in got} == {x[:3] for x in brute(rows)}
    assert sum(r.kept for r in got) == len({norm(r[1]) for r in rows})


def test_state_lasts_over_batches(spark):
    d = D.StreamingDedup(spark)
    path = new_folder(spark, "arriving")
    for batch in ([(5, "a b"), (6, "c")], [(2, "a  b"), (7, "d")]):
        spark.createDataFrame(batch, "doc_id long, text string").write.mode("append").parquet(path)
        d.add(spark.read.parquet(path).where(F.col("doc_id").isin([i for i, _ in batch])))
    got = {(r.id, r["first"].id, r.group_size) for r in d.result(spark.read.parquet(path)).collect()}
    assert got == {(5, 2, 2), (2, 2, 2), (6, 6, 1), (7, 7, 1)}


def test_empty_table_and_columns_kept(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert D.exact_groups(empty).count() == 0
    kept = D.drop_exact_copies(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "file", "first"]
    assert kept.count() == len({norm(r[1]) for r in ROWS})


def test_hits_on_earlier_batches_are_checked_against_their_files(spark):
    weak = lambda text: F.lit("same")
    d = D.StreamingDedup(spark, digest=weak)
    batches = [[(5, "a b"), (6, "c")], [(7, "d"), (8, "a  b"), (9, "c")]]
    for batch in batches:
        path = new_folder(spark, "arriving")
        spark.createDataFrame(batch, "doc_id long, text string").write.parquet(path)
        docs = spark.read.parquet(path)
        d.add(docs)
    got = {(r.id, r["first"].id, r.group_size) for r in d.result(docs).collect()}
    assert got == {(5, 5, 2), (8, 5, 2), (6, 6, 2), (9, 6, 2), (7, 7, 1)}


def test_a_text_that_is_no_copy_of_an_earlier_batch_stays(spark):
    weak, folder = lambda text: F.lit("same"), new_folder(spark, "lasting")
    schema = "doc_id long, text string"
    assert [r.doc_id for r in D.drop_exact_copies(spark.createDataFrame([(1, "a")], schema), folder, digest=weak).collect()] == [1]
    kept = D.drop_exact_copies(spark.createDataFrame([(2, "b"), (3, "a")], schema), folder, digest=weak)
    assert [r.doc_id for r in kept.collect()] == [2]


def test_a_batch_added_again_changes_nothing(spark):
    folder, schema = new_folder(spark, "again"), "doc_id long, text string"
    rows = spark.createDataFrame([(1, "a"), (2, "a "), (3, "b")], schema)
    for _ in range(3):
        got = [tuple(r) for r in D.exact_groups(rows, folder).select("id", "keep_id", "group_size", "kept").collect()]
        assert sorted(got) == [(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True)]
    path = new_folder(spark, "arriving")
    rows.write.parquet(path)
    for batch in ("doc_id < 3", "doc_id > 1", "true"):  # in part, and in whole
        d = D.StreamingDedup(spark, folder + "-files")
        docs = spark.read.parquet(path).where(batch)
        d.add(docs)
        got = d.result(docs)
    assert sorted((r.id, r["first"].id, r.group_size) for r in got.collect()) == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    assert [r.doc_id for r in D.drop_exact_copies(spark.createDataFrame([(9, "b"), (8, "c")], schema), folder).collect()] == [8]


def test_a_driver_lost_between_log_and_commit(spark, monkeypatch):
    path, schema = new_folder(spark, "arriving"), "doc_id long, text string"
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema).write.parquet(path)
    docs, d = spark.read.parquet(path), D.StreamingDedup(spark)
    with monkeypatch.context() as m:
        m.setattr(D, "_settings", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            d.add(docs)
        except RuntimeError:
            pass
    assert d.log().count() == 3
    d.add(docs)
    assert sorted((r.id, r["first"].id, r.group_size) for r in d.result(docs).collect()) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


def test_three_batches_check_each_hit_once(spark, monkeypatch):
    d = D.StreamingDedup(spark)
    read, real = [], D.StreamingDedup.texts_at

    def counting(self, rows):
        read.append(rows.count())
        return real(self, rows)

    monkeypatch.setattr(D.StreamingDedup, "texts_at", counting)
    rows = [[(5, "a b"), (6, "a  b"), (7, "c")], [(8, "a b"), (4, "a b")], [(9, "a b"), (10, "x"), (3, "c")]]
    for batch in rows:
        path = new_folder(spark, "arriving")
        spark.createDataFrame(batch, "doc_id long, text string").write.parquet(path)
        docs = spark.read.parquet(path)
        d.add(docs)
        got = {(r.id, r["first"].id, r.group_size) for r in d.result(docs).collect()}
    assert read == [1, 2]  # of earlier batches only the kept rows of texts that came again
    assert got == {(i, 4, 5) for i in (4, 5, 6, 8, 9)} | {(7, 3, 2), (3, 3, 2), (10, 10, 1)}


def test_columns_may_have_any_name(spark):
    rows = spark.createDataFrame([(1, "a", "x", "y", 3), (2, "a", "x", "y", 4), (3, "b", "u", "v", 5)], "doc_id long, text string, _kept_file string, `a.b` string, row int")
    kept = D.drop_exact_copies(rows)
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a", "x", "y", 3), (3, "b", "u", "v", 5)]
