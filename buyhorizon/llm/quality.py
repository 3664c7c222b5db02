"""Quality scores from compression with learned zstandard dictionaries.

One dictionary is trained on good and one on bad labelled text. A text is cut
into short pieces (all of it), each piece is compressed with either dictionary,
and the difference of the compressed sizes over the text's bytes is the feature:
positive where the good dictionary saves more. A logistic curve fitted on other
labelled rows turns it into the probability of label 1; it also sees how short
the text is, so that little evidence falls back to the share of good rows.

The fit is bounded: about ``train_docs`` rows per class for the dictionaries and
as many for the curve, chosen by a hash threshold (rows are weighted back to the
classes' shares), and about ``dict_bytes`` of pieces per class reach the driver.

Defined results: null and empty texts have difference 0 and full shortness and
get the curve's value there; with rows of only one class every score is that class (0 or 1),
with none 0.5; null labels are not learned from; repeated labels of a row count
once each; extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

LEVEL = 3
#: Characters at which half of a text's score comes from its shortness: little text, little evidence.
SHORT = 64


@dataclass
class Model:
    good: bytes
    bad: bytes
    piece: int
    curve: list[float]  # of the difference and the shortness, and the base

    def difference(self, texts: list[str | None], cache: dict) -> np.ndarray:
        """(bytes with the bad dictionary - bytes with the good one) / bytes, of whole texts."""
        if not self.good:
            return np.zeros(len(texts))
        if "compress" not in cache:
            cache["compress"] = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                                          write_checksum=False, write_dict_id=False).compress for d in (self.good, self.bad)]
        good, bad = cache["compress"]
        out = np.zeros(len(texts))
        for at, text in enumerate(texts):
            data = (text or "").encode("utf-8", "replace")
            more = 0
            for i in range(0, len(data), self.piece):
                part = data[i:i + self.piece]
                more += len(bad(part)) - len(good(part))
            out[at] = more / max(1, len(data))
        return out


def fraction(part: bytes) -> float:
    """A number in [0, 1) fixed by the bytes."""
    return (xxhash.xxh64_intdigest(part, 11) >> 11) / (1 << 53)


def logistic(features: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> list[float]:
    """A weight per feature column and the base of the logistic curve, by Newton's method on standardised features."""
    mid, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale == 0] = 1
    a = np.column_stack([(features - mid) / scale, np.ones(len(y))])
    penalty = ridge * weight.sum() * np.array([1.0] * features.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        move = np.linalg.solve(curve, a.T @ (weight * (p - y)) + penalty * w)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    own = w[:-1] / scale
    return [*own.tolist(), float(w[-1] - own @ mid)]


def constant(log_odds: float, piece: int) -> Model:
    return Model(b"", b"", piece, [0.0, 0.0, log_odds])


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = 3000, dict_bytes: int = 8_000_000, dict_size: int = 262_144, piece: int = 256) -> Model:
    """Fits on ``docs`` (id, text) with ``labels`` (id, label 0 or 1)."""
    labels = labels.where("id IS NOT NULL AND label IN (0, 1)")
    rows = {int(r.label): r["count"] for r in labels.groupBy("label").count().collect()}
    if len(rows) < 2:
        return constant({0: -700.0, 1: 700.0}.get(next(iter(rows), None), 0.0), piece)
    u = F.pmod(F.xxhash64(F.lit("quality sample"), "id"), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("label") == 1, min(0.5, train_docs / rows[1])).otherwise(min(0.5, train_docs / rows[0]))
    chosen = labels.select("id", F.col("label").cast("int").alias("label"), (u < 0.5).alias("to_train"), (F.pmod(u, F.lit(0.5)) < share).alias("use")).where("use")
    sample = docs.join(F.broadcast(chosen.drop("use")), "id").where("length(text) > 0")  # about 4 x train_docs rows
    train = sample.where("to_train")
    have = {r.label: r.n for r in train.groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    if len(have) < 2:
        return constant(float(np.log(rows[1] / rows[0])), piece)
    keep = {k: min(1.0, dict_bytes / n) for k, n in have.items()}

    def cut(texts: list, which: list) -> list:
        out = []
        for text, label in zip(texts, which, strict=True):
            data = text.encode("utf-8", "replace")
            parts = [data[i:i + piece] for i in range(0, len(data), piece)]
            out.append([p for p in parts if fraction(p) < keep[label]])
        return [out]

    pieces = map_rows(train.select("id", F.col("label").alias("class"), "text", "label"), ["id", "class"], cut, "parts array<binary>")
    found = pieces.select("class", F.explode("parts").alias("part")).distinct().orderBy(F.xxhash64("part"), "part").collect()
    dicts = {}
    for label in (0, 1):
        parts = [bytes(r.part) for r in found if r["class"] == label]
        try:
            dicts[label] = zstandard.train_dictionary(dict_size, parts, k=200, d=8, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too few samples to train on: the pieces themselves are the dictionary
            dicts[label] = b"".join(parts)[-dict_size:]
    model = Model(dicts[1], dicts[0], piece, [])
    curve = differences(sample.where("NOT to_train").select("id", "label", "text"), model, ["id", "label"]).select("label", "difference", "shortness").toPandas()
    y = curve["label"].to_numpy(float)
    if len(set(y)) < 2:
        return constant(float(np.log(rows[1] / rows[0])), piece)
    weight = np.where(y == 1, rows[1] / y.sum(), rows[0] / (len(y) - y.sum()))
    model.curve = logistic(curve[["difference", "shortness"]].to_numpy(float), y, weight / weight.mean())
    return model


def differences(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with ``difference`` and ``shortness``; the one other column is the text."""
    shared = rows.sparkSession.sparkContext.broadcast({"model": vars(model), "cache": {}})
    return map_rows(rows, keep, lambda texts: [Model(**shared.value["model"]).difference(texts, shared.value["cache"]),
                                               [SHORT / (SHORT + len(t or "")) for t in texts]], "difference double, shortness double")


def scores(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with ``score``, the probability of label 1."""
    a, b, base = model.curve
    z = F.col("difference") * a + F.col("shortness") * b + base
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))
    return differences(rows, model, keep).select(*keep, (1 / (1 + F.exp(-z))).alias("score"))
