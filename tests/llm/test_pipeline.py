"""The corpus pipeline, stage by stage against brute force, and on awkward tables."""

import hashlib
import re

import corpus_pipeline as P
import public_tokenizers
from pyspark.sql import functions as F
from test_exact_dedup import norm
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from buyhorizon.llm import mixing
from buyhorizon.llm.common import new_folder
from buyhorizon.llm.langid import UND

D = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "lang", "n_chars", "source", "text"]


def again(spark, df):
    path = new_folder(spark, "test-stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "src1", 0), (9001, " 12 ?", "en", "src1", 4), (9002, "12", None, None, 2), (0, None, "de", "s", 0)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    docs = again(spark, docs.unionByName(odd, allowMissingColumns=True))
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    rows = docs.collect()

    one = again(spark, P.language_id(spark, docs, D))
    assert sorted(one.columns) == COLUMNS
    kept = one.collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in rows if r.text and re.search(r"[^\W\d_]", r.text))

    two = again(spark, P.exact_copies(spark, one, D))
    least = {}
    for r in kept:
        least[norm(r.text)] = min(r.doc_id, least.get(norm(r.text), r.doc_id))
    assert sorted(r.doc_id for r in two.collect()) == sorted(least.values()) and sorted(two.columns) == COLUMNS

    three = again(spark, P.near_copies(spark, two, D))
    points = [(r.doc_id, brute_fingerprint(r.text)) for r in two.collect()]
    assert sorted(r.doc_id for r in three.collect()) == sorted(set(brute_components(points, 2))) and sorted(three.columns) == COLUMNS

    four = again(spark, P.mix(spark, three, D))
    own, mixed = three.collect(), four.collect()
    assert sorted(four.columns) == COLUMNS
    names = sorted({r.source for r in own})
    sizes = [sum(len(words(r.text)) for r in own if r.source == s) for s in names]
    for source, target in zip(names, mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])):
        assert abs(sum(len(words(r.text)) for r in mixed if r.source == source) - target) <= max(200, 0.05 * target)
    texts = {r.doc_id: words(r.text) for r in own}
    for r in mixed:
        whole = iter(texts[r.doc_id])
        assert all(w in whole for w in words(r.text)) and r.n_chars == len(r.text)  # its words, in order
    assert all(sum(len(words(r.text)) for r in mixed if r.doc_id == i) <= 3 * len(t) for i, t in texts.items())

    five = P.encode(spark, four, D).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert len(five) == len(mixed)
    for r in five:
        ids = lib.encode(r.text, add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.ids_sha256) == (ids, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    text = "the and of with that is a thing from over water " * 5
    rows = [(3, text, "en", "a", 1), (3, text, "en", "a", 1), (None, text, "en", "a", 1), (4, "der die und nicht ein haus", "de", None, 1), (5, None, None, "b", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = ["score", "whole", "file", "row", "id", "fp", "digest", "first", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "size", "times", "_kept_file", "_kept_row", "a.b", "mixed",
             "lang_pred", "texts", "parts", "null_id", "component", "_metadata_x"]
    docs = spark.createDataFrame([r + ("x",) * len(clash) for r in rows], schema + "".join(f", `{c}` string" for c in clash))
    for name, stage in P.STAGES:  # each stage alone, too
        alone = stage(spark, again(spark, docs), D)
        assert set(alone.columns) - {"ids", "n_tokens", "ids_sha256", "decoded_sha256"} == set(docs.columns) - {"ids", "n_tokens", "ids_sha256", "decoded_sha256"}
        assert all(r["a.b"] == r._kept_file == "x" for r in alone.collect()), name
    out = P.run(spark, D, docs).collect()
    assert {r.doc_id for r in out} <= {3, 4} and all(r.score == "x" and r.n_tokens == len(r.ids) for r in out)
    assert P.run(spark, D, docs.limit(0)).count() == 0
    nothing_learned = docs.withColumn("lang", F.lit(None).cast("string"))
    assert P.language_id(spark, nothing_learned, D).count() == len(rows) and UND == "und"


def test_short_texts_of_no_clear_language_stay(spark):
    rows = [(i, "same words in all", ("aa", "bb", "cc")[i % 3]) for i in range(90)] + [(900, "x", None), (901, "12", None)]
    docs = again(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    from buyhorizon.llm.queries import language_model
    assert max(language_model(docs).predict(["x"])[1]) < 0.5
    assert sorted(r.doc_id for r in P.language_id(spark, docs, D).collect()) == [*range(90), 900]
