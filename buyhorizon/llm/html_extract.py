"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page's leaf blocks, in order, are a sequence with two labels, main text or
other. Features come from the ancestors (tags, words of class, id and role) and
the text (length, links, ends of sentences, typical words). Emission and
transition weights maximise the regularised likelihood of labelled pages,
with gradients from forward and backward sums; pages are decoded by Viterbi.

Training pages (``html_train``) are of a fixed number, so the fit and the
broadcast weights do not grow with the table; every page is read in whole.

Defined results: null or empty html gives empty text; blocks are joined by one
space; pages without main text give empty text; repeated rows each get a result; an
empty table gives no rows; pages of any length and depth are read whole, in linear
time; extra columns do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .html_blocks import Block, Element, blocks
from .html_train import MAIN, OTHER, labelled_pages

# fixed values: words that boilerplate uses, in the languages of the tables
TYPICAL = re.compile(r"copyright|©|all rights reserved|cookie|privacy|subscribe|newsletter|log ?in|sign ?(up|in)|advertis|sponsored|datenschutz|impressum|anmelden|werbung"
                     r"|s'abonner|publicité|suscr[ií]b|publicidad", re.I)
SIZES = (1, 3, 6, 12, 25, 60)


def place(path: Element | None) -> tuple[str, str]:
    """Features of the innermost element and of the two around it."""
    tags, at = [], path
    while at is not None and len(tags) < 3:
        tags.append(at.tag)
        at = at.parent
    return f"at {tags[0] if tags else ''}", f"under {' '.join(tags[:0:-1])}"


def path_features(path: Element | None) -> list[str]:
    out, at = [], path
    while at is not None:
        out += at.new
        at = at.parent
    return [*out, *place(path)]


def text_features(block: Block, index: int, n: int) -> list[str]:
    text = block.text
    share = block.linked / len(text)
    words = text.count(" ") + 1
    out = [f"words {bisect_left(SIZES, words)}", f"links {0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
           f"ends {text[-1] if text[-1] in '.!?:' else ''}"]
    if index == 0 or index == n - 1:
        out.append("first" if index == 0 else "last")
    if words <= SIZES[-1] and TYPICAL.search(text):
        out.append("typical")
    return out


def _sums(scores: np.ndarray, steps: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward and backward sums of padded sequences: label and pair marginals, log partition total."""
    pages, longest, _ = scores.shape
    alpha = np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0]
    for t in range(1, longest):
        new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + steps, axis=1) + scores[:, t]
        alpha[:, t] = np.where(there[:, t, None], new, alpha[:, t - 1])
    beta = np.zeros_like(scores)
    for t in range(longest - 2, -1, -1):
        new = np.logaddexp.reduce(steps + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(there[:, t + 1, None], new, 0)
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    own = np.exp(alpha + beta - total[:, None, None]) * there[:, :, None]
    pair = np.exp(alpha[:, :-1, :, None] + steps + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]) * there[:, 1:, None, None]
    return own, pair.sum(axis=(0, 1)), total, float(total.sum())


def train(sequences: list[tuple[list[list[str]], list[int]]], ridge: float = 0.05, steps: int = 200, rate: float = 0.1) -> dict:
    """Weights from sequences of (features of each block, labels), by Adam on the regularised log likelihood."""
    number = {f: i for i, f in enumerate(sorted({f for rows, _ in sequences for row in rows for f in row}))}
    longest = max(len(y) for _, y in sequences)
    at, feats, truth = [], [], np.zeros((len(sequences), longest), int)
    there = np.zeros((len(sequences), longest), bool)
    for p, (rows, labels) in enumerate(sequences):
        there[p, :len(labels)] = True
        truth[p, :len(labels)] = labels
        for t, row in enumerate(rows):
            at += [p * longest + t] * len(row)
            feats += [number[f] for f in row]
    at, feats = np.array(at), np.array(feats)
    gold = np.eye(2)[truth] * there[:, :, None]
    gold_pairs = np.einsum("pta,ptb->ab", gold[:, :-1], gold[:, 1:])
    gold_sums = np.zeros((len(number), 2))
    np.add.at(gold_sums, feats, gold.reshape(-1, 2)[at])
    w, moves = np.zeros((len(number), 2)), np.zeros((2, 2))
    memory = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, moves)]
    for step in range(1, steps + 1):
        scores = np.column_stack([np.bincount(at, w[feats, k], there.size) for k in (0, 1)]).reshape(*there.shape, 2)
        own, pairs, _, _ = _sums(scores, moves, there)
        got = np.column_stack([np.bincount(feats, own.reshape(-1, 2)[at, k], len(number)) for k in (0, 1)])
        for x, grad, m in zip((w, moves), (gold_sums - got - ridge * w, gold_pairs - pairs - ridge * moves), memory, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * grad
            m[1] = 0.999 * m[1] + 0.001 * grad * grad
            x += rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return {"weights": {f: float(w[i, 1] - w[i, 0]) for f, i in number.items()}, "moves": moves.tolist()}


def sequence(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page whose blocks carry marks."""
    found = [(b, int(b.text[0] == MAIN)) for b in blocks(page) if b.text.strip(MAIN + OTHER + " ")]
    clean = [b._replace(text=b.text.replace(MAIN, "").replace(OTHER, "").strip() or "-") for b, _ in found]
    return [path_features(b.path) + text_features(b, i, len(clean)) for i, b in enumerate(clean)], [y for _, y in found]


def fit(pages: int = 800, seed: int = 1) -> dict:
    return train([s for s in map(sequence, labelled_pages(pages, seed)) if s[1]])


class Extractor:
    def __init__(self, model: dict):
        self.weights, self.moves = model["weights"], model["moves"]

    def path_score(self, path: Element | None) -> float:
        """The weight of all features of the ancestors; each element adds its own to its parent's, once."""
        get, chain = self.weights.get, []
        while path is not None and path.score is None:
            chain.append(path)
            path = path.parent
        total = path.score if path is not None else 0.0
        for element in reversed(chain):
            total = element.score = total + sum([get(f, 0.0) for f in element.new])
        return total

    def labels(self, found: list[Block]) -> list[int]:
        """The likeliest label sequence (Viterbi)."""
        get, n = self.weights.get, len(found)
        (stay0, to1), (to0, stay1) = self.moves
        zero, one, back = 0.0, 0.0, []
        for i, block in enumerate(found):
            at, under = place(block.path)
            score = self.path_score(block.path) + get(at, 0.0) + get(under, 0.0) + sum([get(f, 0.0) for f in text_features(block, i, n)])
            if i:
                back.append((one + to0 > zero + stay0, one + stay1 > zero + to1))
                zero, one = max(zero + stay0, one + to0), max(zero + to1, one + stay1) + score
            else:
                one = score
        out = [int(one > zero)] if n else []
        for choice in reversed(back):
            out.append(int(choice[out[-1]]))
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page or "")
        return " ".join([b.text for b, y in zip(found, self.labels(found), strict=True) if y])


def extracted(rows: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with the main ``text`` and its code points ``n_chars``; the one other column is the html."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def extract(pages: list) -> list:
        extractor = Extractor(shared.value)
        texts = [extractor.text(p) for p in pages]
        return [texts, [len(t) for t in texts]]

    return map_rows(rows, keep, extract, "text string, n_chars long")
