"""BPE against the tokenizers library; the transducer against whole-word merging."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from buyhorizon.llm import bpe as B

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return B.Bpe(B.load(PATH)), Tokenizer.from_file(PATH)


def library(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


TEXTS = ["", " \t\n", "Hello, world's END!!", "it's IT'S 'll x'y", "<|endoftext|>a<|startoftext|> b <|endoftext|", "Été é ΑΣ ΣΑΣ İstanbul ﬁ ² Ⅷ ٠١ 中文字", "a\x1cb\x85c\xa0d​e",
         "😀👍🏽 $$$ ### \x00 \x7f", "thing" * 2000, "a" * 5000, "é" * 3000, "the " * 20_000]


def test_matches_the_library(both):
    own, lib = both
    for text in TEXTS:
        ids, decoded = library(lib, text)
        assert own.ids(text) == ids, text[:50]
        assert own.decode(ids) == decoded


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40) | st.lists(st.sampled_from(["the", "ing", "'S", "Σ", " ", "́", "<|endoftext|>", "12", "é", "!!", "\n"]), max_size=20).map("".join))
def test_matches_the_library_on_any_text(text):
    own, lib = _cached()
    assert own.ids(text) == library(lib, text)[0]


_BOTH = []


def _cached():
    if not _BOTH:
        _BOTH.append((B.Bpe(B.load(PATH)), Tokenizer.from_file(PATH)))
    return _BOTH[0]


def test_stream_equals_whole_and_memory_is_bounded(both):
    own, _ = both
    rng = random.Random(9)
    streams = [[own.plain[ord(rng.choice(alphabet))] for _ in range(n)] + [own.last[ord("e")]] for alphabet, n in (("ab", 9000), ("abcdefghinotu", 7000), ("aeth", 40), ("aeth", 5000))]
    encoder, out, at, most = B.Encoder(own, 4), [[] for _ in streams], [0] * 4, 0
    none = np.zeros(4, bool)

    def take(tokens, whose):
        for t, w in zip(tokens.tolist(), whose.tolist()):
            out[w].append(t)

    while any(a < len(s) for a, s in zip(at, streams)):
        parts = [s[a:a + rng.randint(1, 700)] for a, s in zip(at, streams)]
        at = [a + len(p) for a, p in zip(at, parts)]
        take(*encoder.feed(np.array(sum(parts, [])), np.repeat(np.arange(4), [len(p) for p in parts]), none))
        most = max(most, np.bincount(encoder.owner).max(initial=0))
    take(*encoder.finish())
    assert out == [own.merge(s) for s in streams] and not len(encoder.symbols)
    assert most <= own.lookahead + 2 * B.WINDOW


def test_every_text_passes_the_encoder_and_the_decoder(both, monkeypatch):
    own, lib = both
    fed, read = [], []
    feed, decode = B.Encoder.feed, B.Decoder.feed
    monkeypatch.setattr(B.Encoder, "feed", lambda self, *a: fed.append(len(a[0])) or feed(self, *a))
    monkeypatch.setattr(B.Decoder, "feed", lambda self, ids: read.append(len(ids)) or decode(self, ids))
    text = "ordinary words, some of them " + "long" * 900
    ids = own.ids(text)
    assert sum(fed) == sum(len(w) for w in {"ordinary", "words", ",", "some", "of", "them", "long" * 900}) and len(fed) == 4
    assert own.decode(ids) == library(lib, text)[1] and sum(read) == len(ids)


def test_lookahead_of_a_small_merge_list_is_sufficient():
    # a chain: whether the last a joins a b decides every merge before it
    merges = [("a", "b"), ("a", "a"), ("aa", "a"), ("c", "aa"), ("c", "a")]
    look = B.sufficient_lookahead(merges, "")
    vocab = {s: i for i, s in enumerate(dict.fromkeys([*B.byte_symbols(), *[a + b for a, b in merges]]))}
    own = B.Bpe({"vocab": vocab, "merges": merges, "suffix": "", "lookahead": look, "pattern": r"\S+", "special": {}, "decoder": "ByteLevel"})
    rng = random.Random(3)
    for _ in range(3000):
        head = [vocab[rng.choice("abc")] for _ in range(rng.randint(1, 14))]
        a, b = (own.merge(head + [vocab[rng.choice("abc")] for _ in range(rng.randint(0, 8))]) for _ in range(2))
        done = 0
        for x, y in zip(a, b):
            if done + own.length[x] > len(head) - look:
                break
            assert x == y
            done += own.length[x]
    assert own.decode(own.ids("abcé")) == "abcé"


def test_byte_decoder_is_incremental(both):
    own, _ = both
    d = B.Decoder(own, "ByteLevel")
    ids = own.ids("naïve 中文 x")
    assert "".join(d.feed([i]) for i in ids) + d.finish() == "naïve 中文 x "
    d = B.Decoder(own, "ByteLevel")
    assert d.feed([own.plain[0xC3]]) == "" and d.feed([own.plain[0xA9]]) == "é" and d.feed([own.plain[0xC3]]) == "" and d.finish() == "�"
    d = B.Decoder(own, None)
    assert d.feed([]) + d.feed(ids[:1]) + d.feed(ids[1:]) + d.finish() == own.decode(ids)


def test_tables(spark, both):
    _, lib = both
    rows = [(i, t, "x") for i, t in enumerate([None, *TEXTS, "again", "again"])] + [(None, "null id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string")
    got = B.round_trip(docs.select("doc_id", "text"), PATH, ["doc_id"]).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        ids, decoded = library(lib, t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    ids = B.encoded(docs.select("doc_id", "text"), PATH, ["doc_id"])
    texts = {r.doc_id: r.text for r in B.decoded(ids, PATH, ["doc_id"]).collect()}
    assert texts == {i: library(lib, t or "")[1] for i, t, _ in rows}
    assert B.round_trip(docs.select("doc_id", "text").limit(0), PATH, ["doc_id"]).count() == 0
