"""Language identification by prediction by partial matching (PPM).

One variable-order byte context tree per language (contexts of up to ``ORDER``
bytes). With the statistics frozen, the code length of a byte after a context
is fixed: the escape probabilities of method C down to the longest context that
has seen the byte, with exclusion of what longer contexts have seen, and a
uniform code over the remaining byte values at the bottom. So the trees of all
languages are turned once into a table of code lengths per (context, byte), and
a text costs one look-up per byte for all languages together. The language with
the shortest code wins; the score is its posterior under equal priors.

Trees are fitted on a bounded sample of labelled rows: about ``train_docs``
documents per language, chosen by a hash threshold, whole texts. The model holds
at most ``max_grams`` byte strings per language and is broadcast.

Defined results: ``und`` with score 0 for null text, text without a letter, or
no labelled row at all; ties go to the first language by name; null languages
are not learned from; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ORDER = 3
UND = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Case is folded; what is neither a letter of ASCII nor part of a longer UTF-8 sequence counts as a space.
FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
PAD = b" " * ORDER
#: Bytes scored at once.
BLOCK = 1 << 18


def symbols(text: str) -> bytes:
    """The bytes of a text that are predicted, after ``ORDER`` spaces of context."""
    return PAD + b" ".join(text.lower().encode("utf-8", "replace").translate(FOLD).split()) + b" "


def count_grams(texts: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ORDER + 1 bytes as integers, and how often they occur."""
    total: dict[int, int] = {}
    for text in texts:
        a = np.frombuffer(symbols(text), np.uint8).astype(np.uint32)
        grams, n = np.unique((a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:], return_counts=True)
        for g, k in zip(grams.tolist(), n.tolist(), strict=True):
            total[g] = total.get(g, 0) + k
    return np.fromiter(total.keys(), np.uint32, len(total)), np.fromiter(total.values(), np.int64, len(total))


@dataclass
class Model:
    """Code lengths in bits: ``bits[state * size + symbol]`` is a row over ``langs``."""

    langs: list[str]
    classes: np.ndarray  # of each byte
    size: int  # number of classes; the last one holds all unseen bytes
    states: np.ndarray  # of each ORDER classes
    bits: np.ndarray

    def totals(self, texts: list[str]) -> np.ndarray:
        """Code length of each whole text in each language, block by block."""
        coded = [symbols(t) for t in texts]
        ends = np.cumsum([len(c) for c in coded])
        starts = ends - [len(c) for c in coded]
        a = self.classes[np.frombuffer(b"".join(coded), np.uint8)]
        out = np.zeros((len(texts), len(self.langs)))
        for lo in range(ORDER, len(a), BLOCK):
            hi = min(lo + BLOCK, len(a))
            x = a[lo - ORDER:hi]
            code = (x[:-3] * np.int32(self.size) + x[1:-2]) * np.int32(self.size) + x[2:-1]  # below 257 ** 3
            cost = self.bits[self.states[code] * np.int64(self.size) + x[3:]]
            first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right")
            for s in starts[first:last + 1]:  # the spaces before a text cost nothing
                cost[max(s, lo) - lo:max(s + ORDER - lo, 0)] = 0
            out[first:last + 1] += np.add.reduceat(cost, np.maximum(starts[first:last + 1], lo) - lo, axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        where = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        if where and self.langs:
            bits = self.totals([texts[i] for i in where])
            best = bits.argmin(axis=1)
            likely = 1 / np.exp2(np.clip(bits.min(axis=1)[:, None] - bits, -1000, 0)).sum(axis=1)
            for i, b, p in zip(where, best, likely, strict=True):
                langs[i], scores[i] = self.langs[b], float(p)
        return langs, scores


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The table of code lengths for per-language counts of byte strings."""
    langs = sorted(counts)
    seen = np.unique(np.concatenate([np.frombuffer(PAD, np.uint8)] + [((g[:, None] >> s) & 255).astype(np.uint8).ravel() for g, _ in counts.values() for s in [np.array([24, 16, 8, 0], np.uint32)]]))
    size = len(seen) + 1
    classes = np.full(256, size - 1, np.int32)
    classes[seen] = np.arange(size - 1)
    grams = {lang: (classes.astype(np.int64)[(g[:, None] >> np.array([24, 16, 8, 0], np.uint32)) & 255], n) for lang, (g, n) in counts.items()}

    def code(columns: np.ndarray) -> np.ndarray:
        out = np.zeros(len(columns), np.int64)
        for j in range(columns.shape[1]):
            out = out * size + columns[:, j]
        return out

    # the contexts of full order seen in any language, then every shorter one they fall back to
    full = np.unique(np.concatenate([code(c[:, :ORDER]) for c, _ in grams.values()]))
    parts = [full]
    for k in range(ORDER - 1, 0, -1):
        parts.append(np.unique(np.concatenate([code(c[:, ORDER - k:ORDER]) for c, _ in grams.values()])))
    number = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    n_states = int(number[-1]) + 1  # the last one is the empty context
    states = np.full(size ** ORDER, n_states - 1, np.int32)
    for k in range(1, ORDER + 1):  # longer contexts overwrite shorter ones
        own = parts[ORDER - k]
        states.reshape(-1, size ** k)[:, own] = (number[ORDER - k] + np.arange(len(own))).astype(np.int32)
    bits = np.empty((n_states, size, len(langs)), np.float32)
    for at, lang in enumerate(langs):
        c, n = grams[lang]
        alive = np.ones((n_states, size), bool)
        spent = np.zeros(n_states)
        cost = np.zeros((n_states, size))
        for k in range(ORDER, -1, -1):
            known, where = np.unique(code(c[:, ORDER - k:ORDER]), return_inverse=True)
            freq = np.zeros((len(known) + 1, size))  # the last row: a context this language has not seen
            np.add.at(freq, (where, c[:, ORDER]), n)
            row = np.full(n_states, len(known))
            for length in range(k, ORDER + 1):
                lo, hi = number[ORDER - length], number[ORDER - length] + (len(parts[ORDER - length]) if length else 1)
                short = parts[ORDER - length] % size ** k if length else np.zeros(1, np.int64)
                found = np.minimum(np.searchsorted(known, short), len(known) - 1)
                row[lo:hi] = np.where(known[found] == short, found, len(known))
            own = freq[row] * alive
            total, kinds = own.sum(axis=1), (own > 0).sum(axis=1)
            here = own > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.where(here, spent[:, None] - np.log2(own / (total + kinds)[:, None]), cost)
                spent = np.where(total > 0, spent - np.log2(kinds / (total + kinds)), spent)
            alive &= ~here
        left = 256 - (size - alive.sum(axis=1))
        bits[:, :, at] = np.where(alive, spent[:, None] + np.log2(np.maximum(left, 1))[:, None], cost)
    return Model(langs, classes, size, states, bits.reshape(n_states * size, len(langs)))


def fit(labelled: DataFrame, train_docs: int = 2000, max_grams: int = 300_000) -> Model:
    """Fits on about ``train_docs`` rows per language of ``labelled`` (id, text, lang)."""
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    rows = dict(labelled.groupBy("lang").count().collect())  # one row per language
    if not rows:
        return Model([], np.zeros(256, np.int64), 1, np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, train_docs / n))])
    sample = labelled.where(F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                g, n = count_grams(part["text"])
                yield pd.DataFrame({"lang": lang, "gram": g.astype(np.int64), "n": n})

    counted = sample.select("lang", "text").mapInPandas(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    every = counted.toPandas()  # bounded by the sample; then cut to the model's bound
    counts = {}
    for lang, part in every.groupby("lang"):
        top = part.sort_values(["n", "gram"], ascending=[False, True]).head(max_grams)
        counts[lang] = (top["gram"].to_numpy(np.uint32), top["n"].to_numpy(np.int64))
    return build(counts)


def predict(rows: DataFrame, model: Model, keep: list[str], inner: str | None = None) -> DataFrame:
    """``keep`` columns of ``rows`` with ``lang_pred`` and ``score``; the text is the one other column, or field ``inner`` of the first."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))
    return map_rows(rows, keep, lambda texts: list(Model(**shared.value).predict(texts)), "lang_pred string, score double", inner)
