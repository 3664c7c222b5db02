"""Length histogram and its suffix sums against direct counts."""

import math

import public_tokenizers as P
import tiktoken

from buyhorizon.llm import token_counts as T

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def test_all_answers(spark):
    texts = [None, "", "a", "a b c", "a b c", "word " * 5000, "x" * 4096, "y " * 70, "Été <|endoftext|> 中文"] + [f"doc {i} " * (i % 17) for i in range(60)]
    enc = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=T.load(PATH), special_tokens={})
    n = [len(enc.encode_ordinary(t or "")) for t in texts]
    rows = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int").select("text")
    hist = T.histogram(T.lengths(rows, PATH, PATTERN, []))
    sums = T.suffix_sums(hist)
    got = {r.n_tokens: r for r in sums.collect()}
    assert set(got) == set(n)
    for k, r in got.items():
        assert r.n_docs == n.count(k) and r.tokens == k * n.count(k)
        assert r.docs_at_least == sum(x >= k for x in n)
        assert r.tokens_at_least == sum(x for x in n if x >= k)
        assert r.truncated_tokens == sum(min(x, k) for x in n)
        assert abs(r.docs_share_at_most - sum(x <= k for x in n) / len(n)) < 1e-12
    assert T.totals(hist, [3, 10**6]).first().asDict() == {"n_docs": len(n), "n_tokens": sum(n), "at_3": sum(min(x, 3) for x in n), "at_1000000": sum(n)}
    assert list(T.quantiles(sums, [0.5, 0.99]).first()) == [sorted(n)[math.ceil(q * len(n)) - 1] for q in (0.5, 0.99)]


def test_empty(spark):
    hist = T.histogram(T.lengths(spark.createDataFrame([], "text string"), PATH, PATTERN, []))
    assert T.suffix_sums(hist).count() == 0
    assert T.totals(hist, [5]).first().n_docs == 0
