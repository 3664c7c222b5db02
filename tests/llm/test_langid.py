"""Language identification: code lengths against a direct PPM coder, held-out accuracy, awkward rows."""

import math
import random

import numpy as np

from buyhorizon.llm import langid as L


def brute_bits(train, text):
    """Code length of a text, byte by byte, walking one language's contexts from the longest down."""
    counts = {}
    for t in train:
        s = L.symbols(t)
        for i in range(L.ORDER, len(s)):
            for k in range(L.ORDER + 1):
                own = counts.setdefault(s[i - k:i], {})
                own[s[i]] = own.get(s[i], 0) + 1
    s, bits = L.symbols(text), 0.0
    for i in range(L.ORDER, len(s)):
        excluded = set()
        for k in range(L.ORDER, -1, -1):
            own = {b: n for b, n in counts.get(s[i - k:i], {}).items() if b not in excluded}
            if not own:
                continue
            total = sum(own.values()) + len(own)
            if s[i] in own:
                bits -= math.log2(own[s[i]] / total)
                break
            bits -= math.log2(len(own) / total)
            excluded |= set(own)
        else:
            bits += math.log2(256 - len(excluded))
    return bits


def test_code_lengths_are_those_of_a_direct_coder():
    rng = random.Random(2)
    train = {"aa": ["the cat sat on the mat", "that that is, is", "Été à la mer"], "bb": ["der hund und die katze", "über die straße", "das ist das"],
             "cc": ["x"]}
    model = L.build({k: L.count_grams(v) for k, v in train.items()})
    texts = ["the mat", "die straße über", "zzz qqq", "日本語 the", "", "a", "Été!! 123 the", "".join(rng.choice("thedasi ü") for _ in range(400))]
    got = model.totals(texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.langs):
            assert abs(got[i, j] - brute_bits(train[lang], t)) < 1e-2, (t, lang)
    small, L.BLOCK = L.BLOCK, 7  # the same over block boundaries
    try:
        assert np.allclose(model.totals(texts), got, atol=1e-3)
    finally:
        L.BLOCK = small


def test_rows_without_letters_and_untrained_models():
    model = L.build({"en": L.count_grams(["the cat"]), "de": L.count_grams(["der hut"])})
    langs, scores = model.predict([None, "", " 12 !?", "the", "der"])
    assert langs == ["und", "und", "und", "en", "de"]
    assert scores[:3] == [0, 0, 0] and all(0.5 <= s <= 1 for s in scores[3:])
    alike = L.build({"b": L.count_grams(["abc"]), "a": L.count_grams(["abc"])})
    assert alike.predict(["语 abc"]) == (["a"], [0.5])  # a tie goes to the first name


def test_fit_and_predict_on_a_table(spark):
    words = {"en": "the and of with that is thing from over water".split(), "de": "der die und nicht ein über straße haus wasser mit".split()}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(words[lang], k=30)), lang if i % 5 else None, "x") for i in range(200) for lang in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows, "id long, text string, lang string, score string")
    model = L.fit(docs)
    got = L.predict(docs.select("id", "text"), model, ["id"]).collect()
    assert {r.id: r.lang_pred for r in got} == {i: ("en", "de")[i % 2] for i in range(200)}
    none = L.fit(docs.where("lang IS NULL"))
    assert {(r.lang_pred, r.score) for r in L.predict(docs.select("id", "text"), none, ["id"]).collect()} == {("und", 0.0)}
    empty = spark.createDataFrame([], docs.schema)
    assert L.predict(empty.select("id", "text"), L.fit(empty), ["id"]).count() == 0


def test_query_on_held_out_documents(spark):
    from buyhorizon.llm.queries import op2_language_id
    d = "/root/testdata/sf0.001"
    got = op2_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 40 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
