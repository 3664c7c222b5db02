"""Phrase collocations by sorted count streams.

Counting. Texts are cut into pieces and words; words are counted first. Then 32-bit
hashes of pairs of frequent words are counted, and last the phrases of two to
``longest`` words whose neighbouring words are all pairs of a frequent hash. A part of
a frequent phrase is frequent, so nothing is lost; what tells frequent words and pairs
apart is a bitmap of fixed size (``BITS``) that knows every one of them, and others by
chance only, whose exact counts then fall short.

Estimation. The frequent phrases form one count stream, with the empty phrase
(count: all words) as its root. Sorted in prefix order, every phrase follows its own
first parts, so one lockstep scan with a stack gives each phrase the counts of all
its first parts. The stream, with those counts, is then sorted in suffix order, where
the same scan gives the counts of the rest parts. Extensions are told by neighbours
on the stacks: a phrase that occurs as often as its first or last words marks those
as covered, and marks and phrases are merged in order. No count is looked up by hash.

A stream is dealt to tasks at boundary phrases drawn from it; the first parts of a
boundary phrase are copied to the task that starts there, so a first word that a
third of all phrases share is scanned by many tasks.

Defined results: null text is empty, null language is ``und``; empty texts, pieces and
tables give no words; a table without frequent words gives no rows; repeated rows count
each; phrases do not cross pieces or documents, however long a text is; ties in score
and count are ordered by the phrase's bytes; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slices, stored

#: Bits of the bitmap of frequent phrases: 8 MB wherever it is sent, whatever the table's size.
BITS = 1 << 26
#: Words that a task counts at once before it hands the counts on.
AT_ONCE = 2_000_000
#: Pair hashes are gathered by their first bits, so many hashes to a range.
RANGE = 1 << 24
#: Phrases of the sorted stream for a task, and the most tasks a stream is dealt to.
PER_TASK, TASKS = 50_000, 4096

_BREAK = b"\n"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 9)
_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
_HASHES = pa.schema([("range", pa.int32()), ("steps", pa.binary()), ("counts", pa.binary())])


class _Words(dict):
    """Word -> number, in order of appearance; -1 for breaks and words not in the bitmap, -2 for nothing."""

    def __init__(self, lang: str, bitmap: np.ndarray | None):
        super().__init__({b"": -2, _BREAK: -1})
        self.lang, self.bitmap, self.list, self.hashes = lang.encode() + b"\t", bitmap, [], []

    def __missing__(self, word: bytes) -> int:
        at, h = -1, xxhash.xxh64_intdigest(self.lang + word, 42)  # the position that ``_bitmap`` gives it
        if self.bitmap is None or int(self.bitmap[(h & (BITS - 1)) >> 6]) >> (h & 63) & 1:
            at = len(self.list)
            self.list.append(word)
            self.hashes.append(h)
        self[word] = at
        return at


def numbers(texts: list[bytes], words: _Words) -> np.ndarray:
    """The words of the texts as numbers, pieces and texts parted by -1."""
    tokens = _BREAK.join(texts).translate(_TABLE).replace(_BREAK, b" \n ").split(b" ")
    ids = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
    return np.append(ids[ids != -2], np.int32(-1))


def unigrams(ids: np.ndarray, words: _Words) -> list[tuple[list, np.ndarray]]:
    """Phrases and their counts: every word, and the empty phrase with the count of all words."""
    own = np.bincount(ids[ids >= 0], minlength=len(words.list))
    return [([b"", *words.list], np.append(own.sum(), own))]


def pair_starts(ids: np.ndarray) -> np.ndarray:
    return np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))


def pair_hashes(ids: np.ndarray, starts: np.ndarray, words: _Words) -> np.ndarray:
    """32-bit hashes of the pairs of words that begin at ``starts``."""
    h = np.array(words.hashes, np.uint64)
    with np.errstate(over="ignore"):
        z = h[ids[starts]] * np.uint64(0x9E3779B97F4A7C15) + h[ids[starts + 1]] * np.uint64(0xC2B2AE3D27D4EB4F)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (z >> np.uint64(32)).astype(np.uint32)


def longer(ids: np.ndarray, words: _Words, pairs: np.ndarray, longest: int) -> list[tuple[list, np.ndarray]]:
    """Phrases of 2 to ``longest`` words whose neighbouring words all are pairs of the bitmap, and their counts."""
    out, starts = [], pair_starts(ids)
    at = pair_hashes(ids, starts, words).astype(np.int64) & (BITS - 1)
    starts = starts[(pairs[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) > 0]
    pair = np.zeros(len(ids), bool)
    pair[starts] = True
    codes, before = ids[starts].astype(np.int64), words.list
    for size in range(2, longest + 1):
        found, codes, counts = np.unique(codes * len(words.list) + ids[starts + size - 1], return_inverse=True, return_counts=True)
        before = [before[c // len(words.list)] + b" " + words.list[c % len(words.list)] for c in found.tolist()]
        out.append((before, counts))
        on = pair[starts + size - 1]  # the next pair begins with the phrase's last word
        starts, codes = starts[on], codes[on]
    return out


def _pieces(docs: DataFrame, schema: str, count, bits: list) -> DataFrame:
    """What ``count(lang, ids, words)`` yields for the words of whole texts, about ``AT_ONCE`` words at a time."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, held, size = shared.value, {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (words, parts) in held.items():
                yield from count(lang, np.concatenate(parts), words, bitmaps)
            held.clear()

        for batch in batches:
            for part in slices(batch):
                by_lang: dict = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    if lang not in held:
                        held[lang] = (_Words(lang, bitmaps[0] if bitmaps else None), [])
                    held[lang][1].append(numbers(texts, held[lang][0]))
                    size += len(held[lang][1][-1])
                if size > AT_ONCE:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.mapInArrow(run, schema)


def counted(docs: DataFrame, least: int, longest: int, bits: list) -> DataFrame:
    """(lang, phrase, f) with f of ``least`` or more: without ``bits`` words and the empty phrase, else phrases of 2 to
    ``longest`` words by the bitmaps of words and pairs."""
    def count(lang: str, ids: np.ndarray, words: _Words, bitmaps: list) -> Iterator[pa.RecordBatch]:
        for phrases, counts in longer(ids, words, bitmaps[1], longest) if bitmaps else unigrams(ids, words):
            for at in range(0, len(phrases), 65536):
                part = pa.array(phrases[at:at + 65536], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(counts[at:at + 65536], pa.int64())], schema=_SCHEMA)

    counts = _pieces(docs, "lang string, phrase string, f long", count, bits).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return counts.where((F.col("f") >= least) | (F.col("phrase") == ""))


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """The bits of all phrases of a table, gathered as at most BITS / 64 words."""
    at = F.xxhash64(F.concat("lang", F.lit("\t"), "phrase"))
    return _gathered(frequent.select(at.bitwiseAND(BITS - 1).alias("at")))


def _gathered(positions: DataFrame) -> np.ndarray:
    """The bitmap with the bits ``at`` set."""
    found = positions.groupBy(F.shiftrightunsigned("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(max(1, BITS // 64), np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _steps(hashes: np.ndarray, counts: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """Ascending hashes by range, as steps of 16 bits (a longer one gets stops of count 0) with counts up to ``top``."""
    span = 65535
    for r in np.unique(hashes // RANGE):
        own = slice(np.searchsorted(hashes, r * RANGE), np.searchsorted(hashes, (r + 1) * RANGE))
        step = np.diff(hashes[own] - r * RANGE, prepend=0)
        stops = np.maximum(0, step - 1) // span
        ends = np.cumsum(stops + 1) - 1
        steps, n = np.full(len(step) + stops.sum(), span, np.uint16), np.zeros(len(step) + stops.sum(), np.uint8)
        steps[ends], n[ends] = step - stops * span, np.minimum(counts[own], top)
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([steps.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], schema=_HASHES)


def _frequent_pairs(docs: DataFrame, least: int, words: np.ndarray) -> np.ndarray:
    """The bitmap of the hashes of pairs of frequent words that occur ``least`` times.

    A count is of no interest beyond ``least`` (or 255, if that is lower), so a byte holds it and sums stop there."""
    top = min(least, 255)

    def count(lang: str, ids: np.ndarray, own: _Words, bitmaps: list) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.unique(pair_hashes(ids, pair_starts(ids), own), return_counts=True)
        yield from _steps(hashes.astype(np.int64), counts, top)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def out() -> pa.RecordBatch:
            at = (np.flatnonzero(sums >= top) + now * RANGE) & (BITS - 1)
            return pa.RecordBatch.from_arrays([pa.array(np.unique(at), pa.int64())], names=["at"])

        for batch in batches:
            for r, steps, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if r != now:
                    if now is not None:
                        yield out()
                    now, sums = r, np.zeros(RANGE, np.uint8)
                at = np.cumsum(np.frombuffer(steps, np.uint16), dtype=np.int64)
                more = np.frombuffer(counts, np.uint8)
                at, more = at[more > 0], more[more > 0]
                sums[at] = np.minimum(top, sums[at].astype(np.int16) + more)
        if now is not None:
            yield out()

    parts = _pieces(docs, "range int, steps binary, counts binary", count, [words])
    return _gathered(parts.repartition("range").sortWithinPartitions("range").mapInArrow(total, "at long"))


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> DataFrame:
    """(lang, words, f) of all phrases of at most ``longest`` words that occur ``least`` times, and per language the empty phrase."""
    found = words = stored(counted(docs, least, 1, []), "words")
    if longest > 1:
        bits = _bitmap(words)
        found = found.unionByName(stored(counted(docs, least, longest, [bits, _frequent_pairs(docs, least, bits)]), "phrases"))
    return found.select("lang", F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " ")).alias("words"), "f")


def _key(lang: str, words: list[str]) -> tuple:
    """Orders as Spark does: by bytes, word by word."""
    return lang.encode(), tuple(w.encode() for w in words)


def boundaries(rows: DataFrame, tasks: int) -> list[tuple]:
    """Up to ``tasks`` - 1 keys that cut the stream into about equal runs, from the keys of least hash."""
    drawn = sorted(_key(*r) for r in rows.select("lang", "key").orderBy(F.xxhash64("lang", "key")).limit(32 * tasks).collect())
    cuts = [drawn[i * len(drawn) // tasks] for i in range(1, tasks)] if drawn else []
    return sorted(set(cuts))


def first_part_counts(rows: DataFrame, out: str) -> DataFrame:
    """Adds ``out`` to the stored count stream ``rows`` (lang, key, f, ...): the counts of the key's first 0, 1, 2, ... words
    short of the whole. Needs every first part of a key to be a row itself."""
    tasks = min(TASKS, rows.count() // PER_TASK + 1)
    cuts = boundaries(rows, tasks) if tasks > 1 else []
    copies: dict = {}
    for i, (lang, words) in enumerate(cuts):
        for n in range(len(words)):
            copies.setdefault((lang, words[:n]), []).append(i + 1)
    schema = rows.schema
    dealt_schema, out_schema = f"part int, copy boolean, {_ddl(schema)}", f"{_ddl(schema)}, {out} array<long>"
    arrow, columns = to_arrow_schema(rows.selectExpr("*", f"CAST(NULL AS array<long>) AS {out}").schema), schema.names
    lang_at, key_at, f_at = columns.index("lang"), columns.index("key"), columns.index("f")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(*k) for k in zip(batch.column(lang_at).to_pylist(), batch.column(key_at).to_pylist(), strict=True)]
            at, part, copy = list(range(len(keys))), [bisect_right(cuts, k) for k in keys], [False] * len(keys)
            for i, k in enumerate(keys):
                for p in copies.get(k, ()):
                    at.append(i)
                    part.append(p)
                    copy.append(True)
            whole = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(copy, pa.bool_()), *whole.columns], names=["part", "copy", *columns])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []  # the run that is read, and the chain of first parts with their counts
        for batch in batches:
            keep, counts = [], []
            own = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2 + lang_at).to_pylist(),
                      batch.column(2 + key_at).to_pylist(), batch.column(2 + f_at).to_pylist(), strict=True)
            for i, (part, copy, lang, key, f) in enumerate(own):
                if (part, lang) != now:
                    now, stack = (part, lang), []
                while stack and stack[-1][0] != key[:len(stack) - 1]:
                    stack.pop()
                if len(stack) != len(key):
                    raise ValueError(f"a first part of {key!r} is missing")
                if not copy:
                    keep.append(i)
                    counts.append([c for _, c in stack])
                stack.append((key, f))
            whole = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*whole.columns[2:], pa.array(counts, pa.list_(pa.int64()))], schema=arrow)

    dealt = rows.mapInArrow(deal, dealt_schema).repartitionByRange(tasks, "part").sortWithinPartitions("part", "lang", "key")
    return dealt.mapInArrow(scan, out_schema)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def collocations(frequent: DataFrame, most_words: int = 5) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of 2 words or more that no longer phrase covers."""
    stream = stored(frequent.select("lang", F.col("words").alias("key"), "f"), "count-stream")
    firsts = first_part_counts(stream, "firsts").select("lang", F.reverse("key").alias("key"), "f", "firsts")
    both = first_part_counts(stored(firsts, "suffix-stream"), "lasts").where("size(key) > 1")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, key, a, firsts, lasts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words, n = key[::-1], firsts[0]
                cuts = [(1000 * a * n // (firsts[k] * lasts[len(words) - k]), k) for k in range(1, len(words))]
                best, k = min(cuts)
                rows.append((lang, words, False, a, firsts[k], lasts[len(words) - k], n, best))
                if len(words) > 2:  # as often as its first or last words: those are covered
                    rows += [(lang, part, True, None, None, None, None, None) for part, f in ((words[:-1], firsts[-1]), (words[1:], lasts[-1])) if a >= f]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(list(zip(*rows, strict=True)) or [[]] * 8, arrow, strict=True)], schema=arrow)

    ddl = "lang string, words array<string>, covered boolean, a long, l long, r long, n long, score long"
    arrow = to_arrow_schema(_schema(ddl))
    scored = both.select("lang", "key", "f", "firsts", "lasts").mapInArrow(score, ddl)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = None  # marks come before their phrase
        for batch in batches:
            keep = []
            for i, row in enumerate(zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True)):
                if row[2]:
                    mark = row[:2]
                elif row[:2] != mark:
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    merged = stored(scored, "scored").repartitionByRange("lang", "words").sortWithinPartitions("lang", "words", F.desc("covered")).mapInArrow(merge, ddl)
    return merged.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score")


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def top(found: DataFrame, most: int = 2000) -> DataFrame:
    """Adds ``rank``: the first ``most`` of each language by score, count and phrase; ranked in 64 shares of a language first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shared = found.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = shared.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("_at") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
