"""Toxic passages: maximum-scoring segments of token log-odds.

Every word gets the difference of its log-odds in toxic and in clean labelled text,
with an informative Dirichlet prior (the words' shares in both together). A word's
occurrences count once per pair of neighbouring words, so that copies of a text prove
nothing twice. Words whose log-odds are not beyond ``strong`` by ``sure`` standard
errors are one common token whose own log-odds are a little below zero. A text is scanned once for all its maximal scoring segments (every passage whose score
can be raised neither by shrinking nor by growing it), in linear time.

In a clean text of n words, segments of score S or more are expected
E = K n exp(-lambda S) times, the extreme-value law of such scans: lambda solves
sum p exp(lambda s) = 1 over the words of clean text, K comes from the segments that
clean labelled texts have. A passage is significant if E is at most ``expect``. A
text's score is a posterior: the log-odds of a toxic row, plus -log E of each of its
segments with E below 1; a text without any gets the log of the ratio of the shares
of toxic and clean labelled texts without one instead.

The fit is bounded: at most about ``train_docs`` labelled rows per class, chosen by a
hash threshold. Its vocabulary is theirs, and what tasks get is the words that are
surely toxic or clean. Scoring reads every whole text.

Defined results: null, empty and word-less texts have no passage and get the prior
share of toxic rows; with labelled rows of one class only every score is that class
(0 or 1), with none 0.5; null labels and ids are not learned from; a row with several
labels is learned from with each of them; repeated rows are scored each; an empty
table gives no rows; very long texts are scanned whole; extra columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


@dataclass
class Model:
    """Log-odds of the words that are surely toxic or clean, of all others, and the extreme-value law."""

    odds: dict[str, float] = field(default_factory=dict)
    other: float = 0.0
    rate: float = 1.0  # lambda
    size: float = 1.0  # K
    prior: float = 0.5  # share of toxic rows
    none: float = 0.0  # log ratio of the shares of toxic and clean texts without a segment
    expect: float = 0.01

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        """(score, first word, word after the last) of all maximal scoring segments."""
        get, items, at = self.odds.get, [], 0
        for i, word in enumerate(words):
            odds = get(word)
            if odds is not None:  # a run of other words is one item: no segment starts or ends inside it
                if i > at:
                    items.append((self.other * (i - at), at, i))
                items.append((odds, i, i + 1))
                at = i + 1
        return maximal_segments(items)

    def surprise(self, score: float, n: int) -> float:
        """-log of the number of segments of a clean text of n words that score as much."""
        return self.rate * score - math.log(self.size * n)

    def score(self, words: list[str], segments: list[tuple[float, int, int]]) -> float:
        """The probability of toxic of a text with these segments."""
        if self.prior in (0.0, 1.0):
            return self.prior
        gains = [g for g in (self.surprise(s, len(words)) for s, _, _ in segments) if g > 0]
        z = math.log(self.prior / (1 - self.prior)) + (sum(gains) if gains else self.none if words else 0.0)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def words_of(text: str | None) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-case words of a text, and where each lies in it."""
    found = [m.span() for m in _WORD.finditer(text or "")]
    return [(text or "")[a:b].lower() for a, b in found], found


def maximal_segments(items: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of (score, start, end) items in order, by one scan over them.

    Candidates are kept with the sums before (low) and after (high) them. A new one is joined to the
    last candidate with a lower low if that one's high is lower too, and stands alone otherwise; every
    candidate keeps the place of the last one with a lower low, so a join skips those between.
    """
    kept: list[tuple[float, float, int, int, int]] = []  # low, high, start, end, place of the last with a lower low
    total = 0.0
    for score, start, end in items:
        low, total = total, total + score
        if score <= 0:
            continue
        high = total
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][0] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= high:
                kept.append((low, high, start, end, j))
                break
            low, start = kept[j][0], kept[j][2]
            before = kept[j][4]
            del kept[j:]
            j = before
    return [(high - low, start, end) for low, high, start, end, _ in kept]


def solve_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive lambda with sum of shares x exp(lambda x score) = 1, or 1 where the mean score is not negative; one score must be positive."""
    if (shares * scores).sum() >= 0:
        return 1.0
    top = 1.0
    while (shares * np.exp(np.minimum(700.0, top * scores))).sum() < 1:
        top *= 2
    low = 0.0
    for _ in range(200):
        mid = (low + top) / 2
        low, top = (mid, top) if (shares * np.exp(np.minimum(700.0, mid * scores))).sum() < 1 else (low, mid)
    return (low + top) / 2


def log_odds(counts: dict[str, tuple[int, int]], sure: float, strong: float, prior_words: float) -> tuple[dict[str, float], float]:
    """The words surely toxic or clean with their log-odds, and the log-odds of all others, from (clean, toxic) counts.

    A word's prior is its share of all words times ``prior_words``, the same for both classes."""
    n0, n1 = (sum(c[k] for c in counts.values()) for k in (0, 1))
    odds, rest0, rest1 = {}, 0, 0
    for word, (y0, y1) in counts.items():
        a = prior_words * (y0 + y1) / (n0 + n1)
        if a:
            delta = math.log((y1 + a) / (n1 + prior_words - y1 - a)) - math.log((y0 + a) / (n0 + prior_words - y0 - a))
            if word and abs(delta) - sure * math.sqrt(1 / (y0 + a) + 1 / (y1 + a)) > strong:
                odds[word] = delta
                continue
        rest0, rest1 = rest0 + y0, rest1 + y1
    other = math.log((rest1 + 1) / (n1 + 1)) - math.log((rest0 + 1) / (n0 + 1))
    return odds, min(other, -1e-4)  # a passage must cost something to go on


def contexts(text: str | None) -> set[tuple[str, int]]:
    """The words of a text, each once per pair of neighbours."""
    words = words_of(text)[0]
    return {(w, xxhash.xxh64_intdigest(f"{a} {b}") - (1 << 63)) for a, w, b in zip(["", *words], words, [*words[1:], ""], strict=False)}


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = 5000, sure: float = 2.5, strong: float = math.log(3), expect: float = 0.01) -> Model:
    """Fits on ``docs`` (id, text) with ``labels`` (id, label 0 or 1)."""
    docs, labels = docs.select("id", "text"), labels.select("id", "label").where("id IS NOT NULL AND label IN (0, 1)")
    rows = {int(r.label): r["count"] for r in labels.groupBy("label").count().collect()}
    if len(rows) < 2:
        return Model(prior={0: 0.0, 1: 1.0}.get(next(iter(rows), None), 0.5))
    u = F.pmod(F.xxhash64(F.lit("toxicity sample"), "id"), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("label") == 1, min(1.0, train_docs / rows[1])).otherwise(min(1.0, train_docs / rows[0]))
    chosen = labels.where(u < share).select("id", F.col("label").cast("int").alias("label"))
    chosen = F.broadcast(chosen)  # about 2 x train_docs ids, whatever the table's size: texts are not shuffled
    sample = stored(docs.join(chosen, "id").select("label", "text"), "toxicity-sample")

    def tally(texts: list) -> list:
        return [[[{"word": w, "context": c} for w, c in contexts(text)] for text in texts]]

    seen = map_rows(sample, ["label"], tally, "words array<struct<word:string,context:long>>").select("label", F.explode("words").alias("w"))
    by_word = seen.select("label", "w.word", "w.context").distinct().groupBy("word").agg(
        F.count(F.when(F.col("label") == 0, 1)).alias("clean"), F.count(F.when(F.col("label") == 1, 1)).alias("toxic"))
    by_word = stored(by_word, "toxicity-words")
    totals = by_word.agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    model = Model(prior=rows[1] / (rows[0] + rows[1]), expect=expect)
    if not all(totals):
        return model
    counts = {r.word: (r.clean, r.toxic) for r in by_word.where("clean + toxic > 2").collect()}  # of the sample: bounded
    counts[""] = tuple(n - sum(c[k] for c in counts.values()) for k, n in enumerate(totals))
    model.odds, model.other = log_odds(counts, sure, strong, 0.3 * min(totals))
    if not any(v > 0 for v in model.odds.values()):
        return model
    # a toxic word that clean text lacks may occur there, half a time in as many words
    shares = np.array([max(0.5, counts[w][0]) for w in model.odds] + [totals[0] - sum(counts[w][0] for w in model.odds)]) / totals[0]
    model.rate = solve_rate(np.array([*model.odds.values(), model.other]), shares / shares.sum())
    return calibrated(model, sample)


def calibrated(model: Model, sample: DataFrame) -> Model:
    """The model with K and the worth of a text without segments, from labelled texts (label, text).

    Every segment scores the least toxic word's log-odds t or more, so K is the number of segments of
    clean text (half a segment at least) over its words x exp(-lambda t)."""
    shared = sample.sparkSession.sparkContext.broadcast(vars(model))

    def scan(texts: list) -> list:
        words = [words_of(text)[0] for text in texts]
        return [[len(w) for w in words], [len(Model(**shared.value).segments(w)) for w in words]]

    made = map_rows(sample, ["label"], scan, "n long, segments long").where("n > 0").groupBy("label").agg(
        F.sum("n").alias("n"), F.sum("segments").alias("segments"), F.count(F.lit(1)).alias("texts"), F.count(F.when(F.col("segments") == 0, 1)).alias("without"))
    by = {r.label: r for r in made.collect()}
    least = min(v for v in model.odds.values() if v > 0)
    model.size = max(0.5, by[0].segments) / by[0].n * math.exp(model.rate * least)
    without = [(by[k].without + 0.5) / (by[k].texts + 1) for k in (0, 1)]
    model.none = min(0.0, math.log(without[1] / without[0]))
    return model


def passages(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with ``score`` and ``passages``: every significant passage as (start, end) in code points,
    its text, its segment score and its expected number in a clean text. The one other column is the text."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))

    def scan(texts: list) -> list:
        own, scores, found = Model(**shared.value), [], []
        for text in texts:
            words, spans = words_of(text)
            segments = own.segments(words)
            best = [s for s in segments if own.surprise(s[0], len(words)) >= -math.log(own.expect)]
            scores.append(own.score(words, segments))
            found.append([{"start": spans[i][0], "end": spans[j - 1][1], "passage": text[spans[i][0]:spans[j - 1][1]], "segment_score": s,
                           "expected": math.exp(-min(700.0, own.surprise(s, len(words))))} for s, i, j in best])
        return [scores, found]

    return map_rows(rows, keep, scan, "score double, passages array<struct<start:int,end:int,passage:string,segment_score:double,expected:double>>")
