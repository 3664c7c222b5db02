"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoder.

How far can text that is still to come change tokens already seen? A merge
(a, b) can only carry a difference leftwards if b starts where the difference
starts, so b begins with the left part of an earlier merge that carried it
there, and a chain of such merges must rise in rank. The longest chain, summed
over the left parts, is the merge list's sufficient lookahead: tokens that end
that many symbols before the end of what has been read are stable and leave the
buffer. So the encoder's memory is constant, however long a word is. All distinct
words of a batch are streams of one encoder: they are read side by side, ``WINDOW``
symbols at a time, and whatever is stable is emitted; the end of a word needs no
lookahead, so most words are final with their first window.

The decoder is a state machine over ids, fed with each text's ids in pieces: with a
byte-level decoder it holds at most the bytes of one unfinished character; tokenizer
files without a decoder join token strings by spaces, as the tokenizers library does.

The vocabulary file (a parameter, never copied) is read on the driver and
broadcast: its size is fixed by the vocabulary.

Defined results: null text is empty (no ids, empty decoded text); special tokens
written in a text are their ids, as in the library; repeated rows each get a
result; an empty table gives no rows; texts and words of any length are read whole;
extra columns do not matter.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import map_rows

#: Symbols read between two emissions of a word.
WINDOW = 1024
#: Symbols of a buffer up to which its merges are made in columns with all others', beyond that with a heap of their own.
COLUMNS = 256
#: Ids that the decoder is fed at once.
PIECE = 4096
#: Characters that split() takes for white space and the tokenizers' patterns do not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Letters and numbers that Unicode 16 added, which Python's tables (15.1) lack.
IN_16 = re.compile("[\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d40-\U00010d65\U00010d6f-\U00010d85\U00010ec2-\U00010ec4"
                   "\U00011380-\U000113b5\U000113b7\U000113d1\U000113d3\U000116d0-\U000116e3\U00011bc0-\U00011be0\U00011bf0-\U00011bf9"
                   "\U00013460-\U000143fa\U00016100-\U0001611d\U00016130-\U00016139\U00016d40-\U00016d6c\U00016d70-\U00016d79\U00018cff"
                   "\U0001ccf0-\U0001ccf9\U0001e5d0-\U0001e5ed\U0001e5f0-\U0001e5fa]")
_NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """Symbols that must follow a token before nothing to come can change it."""
    reach: dict[str, int] = {}
    for a, b in merges:
        ended = bool(suffix) and b.endswith(suffix)
        symbols = b[:-len(suffix)] if ended else b
        carried = max((reach.get(symbols[:n], 0) for n in range(1, len(symbols) + (not ended))), default=0)
        reach[a] = max(reach.get(a, 0), len(a) + carried)
    return max(reach.values(), default=0)


class Encoder:
    """Symbols of many streams in, stable tokens out; holds at most lookahead + 2 x WINDOW symbols of each."""

    def __init__(self, bpe: Bpe, streams: int):
        self.bpe, self.streams = bpe, streams
        self.symbols, self.owner = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def feed(self, symbols: np.ndarray, owner: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reads symbols (each of its ``owner``, in order); gives the tokens that are stable now, and whose they are.
        Streams that ``ended`` have no more to come: all of theirs is stable."""
        symbols, owner = np.concatenate([self.symbols, symbols]), np.concatenate([self.owner, owner])
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        size = np.bincount(owner, minlength=self.streams)
        due = (ended | (size > self.bpe.lookahead + WINDOW // 2))[owner]
        of = np.flatnonzero(np.bincount(owner[due], minlength=self.streams))
        tokens, starts = self.bpe.merged(symbols[due], size[of])
        counts = np.diff(starts)
        whose, lengths = np.repeat(of, counts), self.bpe.length_of[tokens]
        upto = np.cumsum(lengths)
        upto -= np.repeat(np.concatenate([[0], upto])[starts[:-1]], counts)
        stable = ended[whose] | (upto <= size[whose] - self.bpe.lookahead)
        gone = np.bincount(whose[stable], lengths[stable], self.streams).astype(np.int64)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        self.symbols, self.owner = symbols[place >= gone[owner]], owner[place >= gone[owner]]
        return tokens[stable], whose[stable]

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        return self.feed(np.zeros(0, np.int64), np.zeros(0, np.int64), np.ones(self.streams, bool))


class Decoder:
    """Ids in, text out, piece by piece; ``finish`` ends the text.

    With ``kind`` None, token strings joined by spaces; with "ByteLevel", the
    UTF-8 text of the tokens' bytes, where broken sequences become U+FFFD.
    """

    def __init__(self, bpe: Bpe, kind: str | None):
        self.bpe, self.kind, self.between = bpe, kind, ""
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace") if kind else None

    def feed(self, ids: list[int]) -> str:
        if self.kind:
            return self.utf8.decode(b"".join([self.bpe.spelled(i) for i in ids]))
        if not ids:
            return ""
        text = self.between + " ".join([self.bpe.strings[i] for i in ids])
        self.between = " "
        return text

    def finish(self) -> str:
        return self.utf8.decode(b"", True) if self.kind else ""


class Bpe:
    """The parts of a tokenizer file that matter here; ``spec`` as ``load`` gives it."""

    def __init__(self, spec: dict):
        vocab, self.suffix = spec["vocab"], spec["suffix"]
        self.strings = {i: s for s, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for a, b in spec["merges"]:
            self.rank.setdefault((vocab[a], vocab[b]), len(self.made))
            self.made.append(vocab[a + b])
        self.lookahead = spec["lookahead"]
        self.symbols = byte_symbols()
        self.bytes_of = {c: bytes([b]) for b, c in enumerate(self.symbols)}
        self.plain = [vocab[c] for c in self.symbols]
        self.last = [vocab[c + self.suffix] for c in self.symbols]
        self.length = {i: len(s) - len(self.suffix) if self.suffix and s.endswith(self.suffix) else len(s) for s, i in vocab.items()}
        self.data_of: dict[int, bytes] = {}
        self.words = regex.compile(spec["pattern"])
        self.special = {s: i for s, i in spec["special"].items()}
        self.strings |= {i: s for s, i in self.special.items()}
        self.on_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.kind = spec["decoder"]
        # the same as columns
        most = max(self.strings) + 1
        self.digits = pa.array([str(i) for i in range(most)])
        self.length_of = np.array([self.length.get(i, 0) for i in range(most)], np.int64)
        self.plain_of, self.last_of = np.array(self.plain, np.int64), np.array(self.last, np.int64)
        self.made_of = np.array(self.made, np.int64)
        keys = np.array([(a << 32) | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order]

    def spelled(self, token: int) -> bytes:
        """The bytes of a token; the end of a word is a space."""
        if token not in self.data_of:
            text, suffix = self.strings[token], self.suffix
            ended = bool(suffix) and text.endswith(suffix)
            self.data_of[token] = b"".join([self.bytes_of.get(c, c.encode()) for c in (text[:-len(suffix)] if ended else text)]) + b" " * ended
        return self.data_of[token]

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of a run of symbols, lowest rank first, from the left."""
        if len(symbols) > 64:
            return self._merge_long(symbols)
        ids, rank, made = list(symbols), self.rank.get, self.made
        ranks = [rank(p, _NONE) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), _NONE)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), _NONE)
        return ids

    def _merge_long(self, symbols: list[int]) -> list[int]:
        ids, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(ids, ids[1:])) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = self.made[r], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := self.rank.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (q, x, (ids[x], ids[y])))
        return [x for x in ids if x is not None]

    def transduced(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of many words, each a stream of one encoder, and where each word's tokens start."""
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size) - size
        symbols = self.plain_of[np.frombuffer(b"".join(words), np.uint8)]
        symbols[begin + size - 1] = self.last_of[np.frombuffer(bytes([w[-1] for w in words]), np.uint8)]
        encoder, open_, at, out = Encoder(self, len(words)), np.arange(len(words)), 0, []
        while len(open_):
            n = np.minimum(size[open_] - at, WINDOW)
            ended = np.zeros(len(words), bool)
            ended[open_] = size[open_] <= at + WINDOW
            place = np.arange(n.sum()) + np.repeat(begin[open_] + at - np.cumsum(n) + n, n)
            out.append(encoder.feed(symbols[place], np.repeat(open_, n), ended))
            open_, at = open_[~ended[open_]], at + WINDOW
        tokens, of = (np.concatenate(x) for x in zip(*out, strict=True))
        return tokens[np.argsort(of, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))])

    def merged(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merges of many buffers, one after the other in ``symbols``: their tokens, and where each one's start."""
        if not len(size):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        if size.max() <= COLUMNS:
            return self.merge_all(symbols, size)
        begin, short = np.cumsum(size) - size, size <= COLUMNS
        tokens, starts = self.merge_all(symbols[np.repeat(short, size)], size[short]) if short.any() else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        pieces = dict(zip(np.flatnonzero(short).tolist(), np.split(tokens, starts[1:-1]), strict=False))
        pieces |= {i: np.array(self.merge(symbols[begin[i]:begin[i] + size[i]].tolist()), np.int64) for i in np.flatnonzero(~short).tolist()}
        ordered = [pieces[i] for i in range(len(size))]
        return np.concatenate(ordered), np.concatenate([[0], np.cumsum([len(p) for p in ordered])])

    def merge_all(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same in columns: every round merges, in each unfinished buffer, the leftmost pair of lowest rank."""
        symbols = symbols.copy()
        owner = np.repeat(np.arange(len(size)), size)
        ranks = np.full(len(symbols), _NONE)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner] = self.ranks_of(symbols[inner], symbols[inner + 1])
        done_tokens, done_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(ranks, starts)
            counts = np.diff(np.append(starts, len(owner)))
            open_ = np.repeat(best < _NONE, counts)
            done_tokens.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols, owner, ranks = symbols[open_], owner[open_], ranks[open_]
            if not len(symbols):
                break
            lowest = np.repeat(best[best < _NONE], counts[best < _NONE])
            hits = np.flatnonzero(ranks == lowest)
            hits = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]  # the leftmost of each word
            symbols[hits] = self.made_of[ranks[hits]]
            stay = np.ones(len(symbols), bool)
            stay[hits + 1] = False
            at = hits - np.arange(len(hits))  # each merge before moves the later ones one to the left
            symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
            for left in (at - 1, at):
                left = left[left >= 0]
                right = np.minimum(left + 1, len(owner) - 1)
                pair = (owner[left] == owner[right]) & (left < right)
                ranks[left] = _NONE
                ranks[left[pair]] = self.ranks_of(symbols[left[pair]], symbols[right[pair]])
        tokens, of = np.concatenate(done_tokens), np.concatenate(done_owner)
        order = np.argsort(of, kind="stable")
        return tokens[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(size)))])

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def split(self, run: str) -> list[str]:
        """The words of a run without white space."""
        if run.isalpha():
            return [run]
        if run.isascii():
            return self.words.findall(run)
        # the library's patterns know Unicode 16: what is assigned later is neither letter nor number
        shown = "".join(["\ufffd" if unicodedata.category(c) == "Cn" and not IN_16.match(c) else c for c in run])
        return [run[w.start():w.end()] for w in self.words.finditer(shown)]

    def tokens_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each word, and where they start; a special token is a word after a space."""
        special = {i: self.special[w[1:]] for i, w in enumerate(words) if w[0] == " "}
        plain = [w.encode("utf-8", "replace") for w in words if w[0] != " "]
        tokens, starts = self.transduced(plain) if plain else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        if special:
            counts = np.ones(len(words), np.int64)
            counts[[i for i in range(len(words)) if i not in special]] = np.diff(starts)
            all_starts = np.concatenate([[0], np.cumsum(counts)])
            out = np.zeros(all_starts[-1], np.int64)
            place = all_starts[list(special)]
            rest = np.ones(len(out), bool)
            rest[place] = False
            out[place], out[rest] = list(special.values()), tokens
            tokens, starts = out, all_starts
        return tokens, starts

    def runs(self, text: str) -> list[str]:
        """The text's runs without white space, normalised; a special token is a run after a space."""
        out = []
        for k, part in enumerate(self.on_special.split(text) if self.on_special else [text]):
            if k % 2:
                out.append(" " + part)
                continue
            part = unicodedata.normalize("NFC", part)
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            out += [r for r in regex.split(r"\s+", part) if r] if ODD_SPACE.search(part) else part.split()
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's start.

        Each distinct word of the batch is encoded once; runs and texts are put together
        from the distinct words' ids in columns."""
        runs: list[str] = []
        ends = [0]
        for text in texts:
            runs += self.runs(text or "")
            ends.append(len(runs))
        coded = pa.array(runs, pa.string()).dictionary_encode()
        words: list[str] = []
        cuts = [0]
        for run in coded.dictionary.to_pylist():
            words += [run] if run[0] == " " else self.split(run)
            cuts.append(len(words))
        spelled = pa.array(words, pa.string()).dictionary_encode()
        tokens, starts = self.tokens_of(spelled.dictionary.to_pylist())
        tokens, starts = _taken(tokens, starts, spelled.indices.to_numpy())
        tokens, starts = _taken(tokens, starts[np.array(cuts)], coded.indices.to_numpy())
        return tokens, starts[np.array(ends)]

    def ids(self, text: str) -> list[int]:
        return self.encode([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        decoder = Decoder(self, self.kind)
        return "".join([decoder.feed(ids[i:i + PIECE]) for i in range(0, len(ids), PIECE)]) + decoder.finish()


def _taken(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` between ``starts`` in the order ``which``, and their new starts."""
    n = np.diff(starts)[which]
    ends = np.cumsum(n)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[:-1][which] - ends + n, n)], np.concatenate([[0], ends])


def load(path: str) -> dict:
    """What ``Bpe`` needs of a tokenizer file: lower-cased words with an end suffix, byte-level symbols."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, steps = file["model"], [n["type"] for n in file["normalizer"]["normalizers"]]
    split = file["pre_tokenizer"]["pretokenizers"][0]
    if steps != ["NFC", "Replace", "Lowercase"] or not (split["behavior"] == "Removed" and split["invert"]) or model["unk_token"] or model["byte_fallback"]:
        raise ValueError(f"{path} is not a word BPE file of the kind supported")
    merges, suffix = [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or ""
    return {"vocab": model["vocab"], "merges": merges, "suffix": suffix, "pattern": split["pattern"]["Regex"], "lookahead": sufficient_lookahead(merges, suffix),
            "special": {t["content"]: t["id"] for t in file["added_tokens"]}, "decoder": (file["decoder"] or {}).get("type")}


def _on_worker(rows: DataFrame, path: str):
    shared = rows.sparkSession.sparkContext.broadcast({"spec": load(path), "bpe": None})

    def bpe() -> Bpe:
        if shared.value["bpe"] is None:
            shared.value["bpe"] = Bpe(shared.value["spec"])
        return shared.value["bpe"]
    return bpe


def encoded(rows: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with ``ids`` (array of int); the one other column is the text."""
    bpe = _on_worker(rows, path)
    return map_rows(rows, keep, lambda texts: [[bpe().ids(t or "") for t in texts]], "ids array<int>")


def decoded(rows: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with the decoded ``text``; the one other column is the ids."""
    bpe = _on_worker(rows, path)
    return map_rows(rows, keep, lambda ids: [[bpe().decode(i or []) for i in ids]], "text string")


def round_trip(rows: DataFrame, path: str, keep: list[str], with_ids: bool = False, inner: str | None = None) -> DataFrame:
    """``keep`` columns with n_tokens, ids_sha256, decoded_sha256 of each whole text (and its ids), in one pass.

    The text is the one other column, or field ``inner`` of the first kept one.
    """
    bpe = _on_worker(rows, path)

    def both(texts: list) -> list:
        own = bpe()
        ids, starts = own.encode(texts)
        digits = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), own.digits.take(pa.array(ids))), " ").to_pylist()
        decoded = [own.decode(ids[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        sha = lambda values: [hashlib.sha256(v.encode("utf-8", "replace")).hexdigest() for v in values]
        # ids as machine integers: lists of Python integers would take ten times the memory
        whole = [np.split(ids.astype(np.int32), starts[1:-1])] if with_ids else []
        return [*whole, np.diff(starts), sha(digits), sha(decoded)]

    return map_rows(rows, keep, both, "ids array<int>, " * with_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string", inner)
