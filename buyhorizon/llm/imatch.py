"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency, log2(documents /
documents with the term), lies in a band. Counts cover all documents. Since the
band is relative, at most (mean distinct terms of a document) x 2^(upper bound)
terms lie in it, whatever the corpus, so the sorted lexicon can be broadcast.

Each of ``SUBSETS`` random orders of the lexicon gives nested subsets that hold
1, 1/2, 1/4, ... of its terms. For each order, a text's distinct lexicon terms,
sorted, are hashed in the sparsest of these subsets that holds any of them. So
short and long texts alike are hashed over few terms at a time, and the share of
equal hashes says how alike two texts are. A text without a lexicon term is
hashed over all its terms.

Neighbours in identifier order are met by one range shuffle of compressed texts;
only the first and last rows of the partitions are joined afterwards.

Defined results: null text is empty; a text without words has the all-zero
fingerprint; equal fingerprints have likeness 1; rows that repeat an identifier
have a fixed order, by compressed text; a null identifier comes last; a single document is its own
next one; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, stored

SUBSETS = 32
DIGITS = 6
#: Term occurrences (one per document) that a task counts before it hands rows on.
FLUSH = 4_000_000


def terms(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's lower-cased words."""
    hashed = xxhash.xxh64_intdigest
    return np.array(sorted({hashed(w) for w in text.lower().encode("utf-8", "replace").split()}), np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed constants of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ORDERS = _mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: str, lexicon: np.ndarray) -> str:
    found = terms(text)
    if not len(found):
        return "0" * (SUBSETS * DIGITS)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, found), len(lexicon) - 1)
        kept = found[lexicon[at] == found]
        found = kept if len(kept) else found
    drawn = _mix(found[None, :] ^ ORDERS[:, None])
    level = np.frexp(drawn.astype(np.float64))[1]  # halves as the subset does; smaller is sparser
    chosen = level == level.min(axis=1, keepdims=True)
    return "".join([f"{xxhash.xxh64_intdigest(found[own].tobytes(), at) | 1:016x}"[-DIGITS:] for at, own in enumerate(chosen)])


def likeness(a: str, b: str) -> float:
    """Share of the subsets on which two fingerprints agree."""
    return sum(a[i:i + DIGITS] == b[i:i + DIGITS] for i in range(0, SUBSETS * DIGITS, DIGITS)) / SUBSETS


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def lexicon(rows: DataFrame, lowest: float = 4.3, highest: float = 11.0) -> np.ndarray:
    """Sorted hashes of the terms of ``rows.text`` with an IDF in [lowest, highest]."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["term", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(terms(text or ""))
                n += len(held[-1])
                if n >= FLUSH:
                    yield counted()
                    held, n = [], 0
        if n:
            yield counted()

    documents = rows.count()
    frequency = rows.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = frequency.where((F.col("n") >= documents * 2.0 ** -highest) & (F.col("n") <= documents * 2.0 ** -lowest)).select("term")
    return np.sort(band.toPandas()["term"].to_numpy(np.int64).view(np.uint64))  # bounded by the band


def _packed(rows: DataFrame) -> DataFrame:
    def pack(texts: list) -> list:
        c = zstandard.ZstdCompressor(level=1)
        return [[c.compress((t or "").encode("utf-8", "replace")) for t in texts]]

    return map_rows(rows.select("id", "text"), ["id"], pack, "packed binary")


def _unpack(data: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8")


OUT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(row_id, text: str, own: str, following: str, own_next: str, words: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed, words)
    return (row_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), own, other, likeness(own, other), likeness(own, own_next))


def neighbours_compared(rows: DataFrame, lowest: float = 4.3, highest: float = 11.0) -> DataFrame:
    """One row per row of ``rows`` (id, text): its fingerprint, its edited text's, and how alike they and the next text's are."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(rows, lowest, highest))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, before = shared.value, TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for row_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = _unpack(packed)
                own = fingerprint(text, words)
                if before is None:
                    out.append((None,) * 7 + (part, "head", packed))
                else:
                    out.append(_compared(*before[:3], text, own, words) + (part, "row", None))
                before = (row_id, text, own, packed)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((before[0],) + (None,) * 6 + (part, "open", before[3]), types, strict=True)], names=names)

    id_type = dict(rows.dtypes)["id"]
    schema = OUT.replace("id long", f"id {id_type}", 1) + ", part int, kind string, packed binary"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(),
             pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.binary()]
    ordered = _packed(rows).repartitionByRange(F.asc_nulls_last("id")).sortWithinPartitions(F.asc_nulls_last("id"), "packed")
    found = stored(ordered.mapInArrow(compare, schema), "imatch-rows")

    heads = found.where("kind = 'head'").select("part", "packed")
    after = heads.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"))
    edges = (found.where("kind = 'open'").select("id", "part", "packed").join(after, "part")  # one row per partition
             .join(heads.select(F.col("part").alias("next"), F.col("packed").alias("following")), "next"))

    def close(ids: list, packed: list, following: list) -> list:
        out = []
        for row_id, a, b in zip(ids, packed, following, strict=True):
            text, other = _unpack(a), _unpack(b)
            out.append(_compared(row_id, text, fingerprint(text, shared.value), other, fingerprint(other, shared.value), shared.value)[1:])
        return list(zip(*out, strict=True)) if out else [[] for _ in range(6)]

    edges = map_rows(edges.select("id", F.col("id").alias("key"), "packed", "following"), ["id"], close, OUT.split(", ", 1)[1])
    return found.where("kind = 'row'").select(*names[:7]).unionByName(edges)
