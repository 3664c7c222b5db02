"""I-Match fingerprints against brute force over a small corpus."""

import hashlib
import math
import random

import numpy as np
import xxhash
import zstandard

from buyhorizon.llm import imatch as M


def brute_lexicon(texts, lowest, highest):
    df = {}
    for t in texts:
        for w in set((t or "").lower().encode().split()):
            df[w] = df.get(w, 0) + 1
    return np.array(sorted(xxhash.xxh64_intdigest(w) for w, n in df.items() if lowest <= math.log2(len(texts) / n) <= highest), np.uint64)


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(900)]
    rows = [(1000 - 3 * i, " ".join(rng.choices(words, k=rng.randint(1, 120)))) for i in range(150)]
    return rows + [(5000, None), (5001, ""), (5002, " \n "), (5003, "Éa\tÉA ß"), (5004, words[0] + " " + "x " * 40_000), (7, rows[0][1]), (7, "repeated id"), (None, "no id")]


def brute_fingerprint(text, lexicon):
    """The fingerprint term by term: per random order of the lexicon, the text's terms in the sparsest nested
    subset that holds any (all its terms, if the lexicon has none), sorted, hashed."""
    top = 1 << 64

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % top
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % top
        return x ^ (x >> 31)

    own = {xxhash.xxh64_intdigest(w) for w in (text or "").lower().encode().split()}
    if not own:
        return "0" * 192
    held = own & {int(x) for x in lexicon} or own
    out = ""
    for k in range(32):
        order = mixed((k + 1) * 0x9E3779B97F4A7C15 % top)
        halvings = {t: 64 - math.frexp(float(mixed(t ^ order)))[1] for t in held}  # the subset of 2^-n of the lexicon holds t up to this n
        chosen = sorted(t for t in held if halvings[t] == max(halvings.values()))
        digest = xxhash.xxh64_intdigest(b"".join(t.to_bytes(8, "little") for t in chosen), k) | 1
        out += f"{digest:016x}"[-6:]
    return out


def brute_likeness(a, b):
    return sum(a[6 * k:6 * k + 6] == b[6 * k:6 * k + 6] for k in range(32)) / 32


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "id long, text string, fingerprint string")
    got = M.neighbours_compared(docs.select("id", "text"), 1.0, 7.0).collect()
    lex = brute_lexicon([t for _, t in rows], 1.0, 7.0)
    assert (M.lexicon(docs, 1.0, 7.0) == lex).all() and len(lex) > 100
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, zstandard.ZstdCompressor(level=1).compress(r[1].encode())))
    want = {}
    for k, (i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        changed = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        a, b, c = (brute_fingerprint(x, lex) for x in (t, changed, following))
        want[i, t] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, brute_likeness(a, b), brute_likeness(a, c))
    assert len(got) == len(rows)
    assert {(r.id, r.fingerprint, r.edited_sha256): tuple(r)[1:] for r in got} == {(i, w[2], w[1]): w for (i, _), w in want.items()}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_fingerprints():
    lex = brute_lexicon([t for _, t in corpus()], 1.0, 7.0)
    texts = [t or "" for _, t in corpus()]
    assert M.fingerprint("", lex) == M.fingerprint(" \t", lex) == "0" * 192
    assert M.fingerprint("b a a", lex) == M.fingerprint("A b", lex)  # distinct, sorted, lower case
    long = [t for t in texts if 60 < len(t.split()) < 200][:40]
    for a, b in zip(long, long[1:]):
        near = M.likeness(M.fingerprint(a, lex), M.fingerprint(" ".join(a.split()[:-2]), lex))
        half = M.likeness(M.fingerprint(a, lex), M.fingerprint(M.edited(a, b), lex))
        assert near > 0.8 and 0.05 < half < 0.8 and near > half > M.likeness(M.fingerprint(a, lex), M.fingerprint(b, lex))


def test_one_row_and_empty(spark):
    one = M.neighbours_compared(spark.createDataFrame([(3, "a b c d")], "id long, text string")).collect()
    assert [(r.id, r.n_chars, r.near_next) for r in one] == [(3, 7, 1.0)]
    assert M.neighbours_compared(spark.createDataFrame([], "id long, text string")).count() == 0
