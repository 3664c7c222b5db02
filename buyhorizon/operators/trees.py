"""Boosted trees on blocks of binned rows: what one task computes on its own rows.

A block holds its rows as codes: neighbouring features are a bundle as long as few
patterns of their bins occur, and a row has a pattern's number per bundle. Sums over
rows are taken per pattern and then dealt to the bins of the pattern. Per feature the
most frequent bin is left out there and recovered from the totals. Gradients are
rounded to whole multiples of a power of two, so sums are exact: a tree depends neither
on the order of the rows nor on how features are bundled.

Trees grow level by level; among a level's splits those of largest gain come first
when the leaves run out. Of two children the one with fewer rows is summed, the
other is the difference to its parent.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np

#: Rows of a block at most.
BLOCK_ROWS = 65_536
#: Rows at most which one task holds whole: two bytes a bundle and row (with 750 features 1.5 kB if none go together) and about 60 bytes.
TASK_ROWS = 64 * BLOCK_ROWS
#: Patterns of a bundle at most; also not more than a part of the rows, or sums per pattern would save nothing.
PATTERNS, PATTERN_ROWS = 1 << 14, 16
#: Patterns at most of the parts in which a bundle's patterns are dealt to bins.
PART_PATTERNS = 1 << 10
#: Levels of a tree without a depth of its own.
DEEPEST = 32
#: Cells of a block that are summed at once, and rows: they and their sums stay small.
ENTRIES = 1 << 19
STRIPE = 1 << 16
#: Cells of a block that are kept row after row at most, two bytes each; without them small nodes go by patterns, too.
KEPT_CELLS = 1 << 27


@dataclass(frozen=True)
class BoostParams:
    """The parameters of a fit, under the names the reference's learner has for them."""

    learning_rate: float = 0.05
    num_leaves: int = 64
    max_depth: int = -1
    feature_fraction: float = 0.9
    bagging_fraction: float = 0.8
    bagging_freq: int = 5
    min_child_weight: float = 1.5
    min_data_in_leaf: int = 20
    lambda_l2: float = 10.0
    max_bin: int = 32
    seed: int = 2016
    num_boost_round: int = 10000
    early_stopping_rounds: int = 200
    binary: bool = False
    scale_pos_weight: float = 20.0

    def record(self) -> dict:
        return asdict(self)


def mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    """A uniform number in [0, 1) per row id and seed (splitmix64)."""
    with np.errstate(over="ignore"):
        z = ids.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(float) / 2 ** 53


@dataclass
class Cells:
    """Where each feature's bins lie among all bins (cells) of a histogram row."""

    sizes: np.ndarray  # bins per feature, the missing bin included

    def __post_init__(self):
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.total = int(self.sizes.sum())
        self.feature = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.last = np.zeros(self.total, bool)  # a split after a feature's last bin is none
        self.last[self.starts + self.sizes - 1] = True


@dataclass
class Tree:
    """Nodes in the order they were made; a row goes left if its bin of ``feature`` is at most ``bin``."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    rows: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, at: int, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for values, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0), (self.rows, 0)):
                values.append(v)
        return self.left[node], self.right[node]

    def routed(self, bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        """The leaf of every row, from ``node`` on."""
        feature, at, left, right = (np.array(x, np.int64) for x in (self.feature, self.bin, self.left, self.right))
        node = np.zeros(len(bins), np.int64) if node is None else node
        while len(open_ := np.flatnonzero(feature[node] >= 0)):
            n = node[open_]
            node[open_] = np.where(bins[open_, feature[n]] <= at[n], left[n], right[n])
        return node

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.routed(bins)]


@dataclass
class Bundle:
    """Some neighbouring features of all rows: the bins (pattern x feature) of every pattern that occurs, and each row's pattern."""

    first: int
    patterns: np.ndarray
    codes: np.ndarray


def bundles(columns: np.ndarray, sizes: np.ndarray, first: int = 0, most: int | None = None) -> Iterator[Bundle]:
    """The bundles of ``columns`` (features x rows; the first is feature ``first``), from left to right, of ``most`` patterns."""
    own, most = None, min(PATTERNS, max(256, columns.shape[1] // PATTERN_ROWS)) if most is None else most
    for f, (column, size) in enumerate(zip(columns, sizes, strict=True)):
        size = int(size)
        if own is not None:
            both = own.codes.astype(np.int64) * size + column
            there = np.zeros(len(own.patterns) * size, bool)
            there[both] = True
            pairs = np.flatnonzero(there)
            if len(pairs) <= most:
                number = np.zeros(len(there), np.uint16)
                number[pairs] = np.arange(len(pairs))
                own = Bundle(own.first, np.column_stack([own.patterns[pairs // size], (pairs % size).astype(np.uint8)]), number[both])
                continue
            yield own
        own = Bundle(first + f, np.arange(size, dtype=np.uint8)[:, None], column.astype(np.uint16))
    if own is not None:
        yield own


def _runs(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts counts into runs that have about ``most`` together."""
    if len(counts):
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(counts) // most)) + 1), len(counts)]
        yield from zip(cuts, cuts[1:], strict=False)


class Block:
    """Rows of one set of features, from their bins (rows x features) or bundles; ids, and for a single fit targets and which rows are held out."""

    def __init__(self, bins: np.ndarray | list[Bundle], ids: np.ndarray, y: np.ndarray, held: np.ndarray, cells: Cells):
        self.ids, self.y, self.held, self.cells = ids, y, held, cells
        self.bundles = list(bundles(bins.T, cells.sizes)) if isinstance(bins, np.ndarray) else bins
        begin = self.bundles[0].first
        self.at = {b.first - begin + k: (b, k) for b in self.bundles for k in range(b.patterns.shape[1])}
        self.starts = np.cumsum([0, *[len(b.patterns) for b in self.bundles]])  # of each bundle's patterns among all
        usual, counts, cells_of, self.parts, kept = [], [], [], [], 0
        for b in self.bundles:
            rows, features = np.bincount(b.codes, minlength=len(b.patterns)), slice(b.first - begin, b.first - begin + b.patterns.shape[1])
            often = np.array([np.bincount(p, rows).argmax() for p in b.patterns.T])
            odd, own = b.patterns != often, cells.starts[features]
            usual.append(own + often)
            counts.append(odd.sum(axis=1))
            cells_of.append((b.patterns + own)[odd])
            kept += int((rows * counts[-1]).sum())
            self.parts.append(list(bundles(b.patterns.T, cells.sizes[features], features.start, PART_PATTERNS)))
        self.usual, self.counts, self.cells_of = np.concatenate(usual), np.concatenate(counts), np.concatenate(cells_of).astype(np.int32)
        self.begin = np.cumsum(self.counts) - self.counts  # of each pattern's cells that are not usual ones
        # rows from which sums per pattern cost less than the cells of each row, and cells from which parts cost less than cells
        self.many = (45_000 * len(self.bundles) + 12 * self.starts[-1]) / max(1.0, (7 if kept <= KEPT_CELLS else 24) * kept / max(1, len(ids)))
        self.all = sum(len(b.patterns) * len(p) + sum(x.patterns.size for x in p) for b, p in zip(self.bundles, self.parts, strict=True)) // 3
        self.flat = self._cells_by_row(kept) if kept <= KEPT_CELLS and cells.total <= 1 << 16 else None

    def _patterns(self, rows: np.ndarray | slice) -> np.ndarray:
        """The rows' patterns (row x bundle), numbered among all."""
        return np.stack([b.codes[rows] for b in self.bundles], axis=1) + self.starts[:-1]

    def _spread(self, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The places from each beginning on, as many as its count."""
        cum = np.cumsum(counts)
        at = np.repeat(begin - cum + counts, counts)
        at += np.arange(len(at))
        return at

    def _cells_by_row(self, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cells that are not usual ones, row after row; where rows begin; how many each has."""
        n, flat, of, step = len(self.ids), np.empty(kept, np.uint16), [], max(1, ENTRIES // max(1, self.cells.total // 64))
        done = 0
        for i in range(0, n, step):
            patterns = self._patterns(slice(i, i + step))
            counts = self.counts[patterns]
            own = self.cells_of[self._spread(self.begin[patterns.ravel()], counts.ravel())]
            flat[done:done + len(own)] = own
            done += len(own)
            of.append(counts.sum(axis=1))
        of = np.concatenate([np.zeros(0, np.int64), *of])
        return flat, np.cumsum(of) - of, of

    def sums(self, nodes: list[np.ndarray], weights: list[np.ndarray], rows_of: np.ndarray | None = None) -> np.ndarray:
        """Per weight, and for the rows themselves, the sums per node and cell over its rows; ``rows_of`` are those of the rows, if known, of a single node."""
        out = np.zeros((len(weights) + 1, len(nodes), self.cells.total))
        few = [i for i, rows in enumerate(nodes) if len(rows) < self.many]
        if few:
            rows, slot = np.concatenate([nodes[i] for i in few]), np.repeat(np.arange(len(few)), [len(nodes[i]) for i in few])
            out[:, few] = self._sums_of_rows(rows, weights, slot, len(few))
        for i, rows in enumerate(nodes):
            if len(rows) < self.many:
                continue
            per = self._per_pattern(rows, weights if rows_of is not None else [*weights, None])
            if rows_of is not None:
                self._dealt_by_parts(per, out[:-1, i])
                out[-1, i] = rows_of
                continue
            there = np.flatnonzero(per[-1])
            if self.counts[there].sum() < self.all:
                out[:, i] = self._dealt(there, list(per[:, there]))[:, 0]
            else:
                self._dealt_by_parts(per, out[:, i])
        for layer, w in enumerate([*weights, None]):
            whole = np.array([float(len(rows)) if w is None else w[rows].sum() for rows in nodes])
            out[layer][:, self.usual] = 0
            out[layer][:, self.usual] = whole[:, None] - np.add.reduceat(out[layer], self.cells.starts, axis=1)
        return out

    def _sums_of_rows(self, rows: np.ndarray, weights: list[np.ndarray], slot: np.ndarray, slots: int) -> np.ndarray:
        """The sums per slot and cell (usual ones apart) of rows' weights and of the rows, from the cells of each."""
        total, width = self.cells.total, len(self.bundles)
        out = np.zeros((len(weights) + 1, slots * total))
        if self.flat is None:
            step = max(1, ENTRIES // width)
            for i in range(0, len(rows), step):
                r = rows[i:i + step]
                out += self._dealt(self._patterns(r).ravel(), [np.repeat(w[r], width) for w in weights] + [None], np.repeat(slot[i:i + step], width), slots).reshape(out.shape)
            return out.reshape(-1, slots, total)
        flat, begin, counts = self.flat
        most = max(ENTRIES, 2 * slots * total)
        for first, end in _runs(counts[rows], most):
            r, own = rows[first:end], counts[rows[first:end]]
            at = flat[self._spread(begin[r], own)] + np.repeat(slot[first:end] * total, own)
            for layer, w in enumerate([*weights, None]):
                out[layer] += np.bincount(at, None if w is None else np.repeat(w[r], own), slots * total)
        return out.reshape(-1, slots, total)

    def _per_pattern(self, rows: np.ndarray, weights: list[np.ndarray | None]) -> np.ndarray:
        """The sums per pattern of all bundles over ``rows``; without weights rows count."""
        out = np.zeros((len(weights), self.starts[-1]))
        for i in range(0, len(rows), STRIPE):
            r = rows[i:i + STRIPE]
            own = [None if w is None else w[r] for w in weights]
            for b, start in zip(self.bundles, self.starts, strict=False):
                codes, n = b.codes[r].astype(np.int64), len(b.patterns)
                for layer, w in enumerate(own):
                    out[layer, start:start + n] += np.bincount(codes, w, n)
        return out

    def _dealt_by_parts(self, per: np.ndarray, out: np.ndarray) -> None:
        """Puts sums per pattern (of all patterns) into their cells, by parts of the bundles."""
        for b, start, parts in zip(self.bundles, self.starts, self.parts, strict=False):
            for part in parts:
                codes, columns = part.codes.astype(np.int64), part.patterns.T.astype(np.int64)
                for layer, sums in enumerate(per):
                    own = np.bincount(codes, sums[start:start + len(b.patterns)], len(part.patterns))
                    for f, column in enumerate(columns, part.first):
                        at, size = self.cells.starts[f], self.cells.sizes[f]
                        out[layer, at:at + size] = np.bincount(column, own, size)

    def _dealt(self, patterns: np.ndarray, weights: list[np.ndarray | None], slot: np.ndarray | None = None, slots: int = 1) -> np.ndarray:
        """The sums per slot and cell (usual ones apart) of patterns' weights, each pattern in its slot; without weights patterns count."""
        counts, total = self.counts[patterns], self.cells.total
        out, most = np.zeros((len(weights), slots * total)), max(ENTRIES, 2 * slots * total)
        for first, end in _runs(counts, most):
            own, p = counts[first:end], patterns[first:end]
            at = self.cells_of[self._spread(self.begin[p], own)].astype(np.int64)
            if slot is not None:
                at += np.repeat(slot[first:end] * total, own)
            for layer, w in enumerate(weights):
                out[layer] += np.bincount(at, None if w is None else np.repeat(w[first:end], own), slots * total)
        return out.reshape(len(weights), slots, total)

    def goes_left(self, rows: np.ndarray, feature: int, at: int) -> np.ndarray:
        """Which rows have at most the bin ``at`` of a feature."""
        b, k = self.at[feature]
        return (b.patterns[:, k] <= at)[b.codes[rows]]


def gradients(p: BoostParams, y: np.ndarray, margin: np.ndarray, scale: float) -> list[np.ndarray]:
    """Slopes (and curvatures, where they are not one) of the loss, in whole multiples of 1 / scale."""
    if not p.binary:
        return [np.rint((margin - y) * scale)]
    chance = 1 / (1 + np.exp(-margin))
    weight = np.where(y > 0, p.scale_pos_weight, 1.0)
    return [np.rint((chance - (y > 0)) * weight * scale), np.rint(np.maximum(chance * (1 - chance), 1e-16) * weight * scale)]


def losses(p: BoostParams, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Squared errors, or the weighted log losses of a binary fit, in whole multiples of 2^-20 (so that sums are exact)."""
    if not p.binary:
        return np.rint((margin - y) ** 2 * 2 ** 20)
    signed = np.where(y > 0, -margin, margin)
    return np.rint((np.maximum(signed, 0) + np.log1p(np.exp(-np.abs(signed)))) * np.where(y > 0, p.scale_pos_weight, 1.0) * 2 ** 20)


def weight_of(p: BoostParams, y: np.ndarray) -> np.ndarray:
    return np.where(y > 0, p.scale_pos_weight, 1.0) if p.binary else np.ones(len(y))


def in_bag(p: BoostParams, ids: np.ndarray, round_: int) -> np.ndarray:
    """The rows a round's tree is grown on: a new draw every ``bagging_freq`` rounds."""
    if p.bagging_freq <= 0 or p.bagging_fraction >= 1:
        return np.ones(len(ids), bool)
    return mixed(ids, p.seed + 7919 * (round_ // p.bagging_freq + 1)) < p.bagging_fraction


def features_of(p: BoostParams, n: int, round_: int) -> np.ndarray:
    """The features a round's tree may split on."""
    allowed = np.ones(n, bool)
    if p.feature_fraction < 1:
        allowed[np.random.default_rng([p.seed, round_]).permutation(n)[max(1, round(n * p.feature_fraction)):]] = False
    return allowed


def best_splits(level: list[np.ndarray], cells: Cells, p: BoostParams, allowed: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Per node: the best split's gain and its cell. The last layer of a node's histogram counts rows."""
    gains, cells_at = np.full(len(level), -np.inf), np.zeros(len(level), np.int64)
    may, enough = ~cells.last & np.repeat(allowed, cells.sizes), max(1, p.min_data_in_leaf)

    def before(run: np.ndarray) -> np.ndarray:
        return np.where(cells.starts > 0, run[cells.starts - 1], 0.0)

    for i, hist in enumerate(level):
        total_g, *_, total_rows = totals = hist[:, :cells.sizes[0]].sum(axis=1)
        run = np.cumsum(hist[-1])
        nl = run - np.repeat(before(run), cells.sizes)
        at = np.flatnonzero((nl >= enough) & (nl <= total_rows - enough) & may)  # few cells where nodes are small
        if not len(at):
            continue

        def left(values: np.ndarray) -> np.ndarray:
            run = np.cumsum(values)
            return (run[at] - before(run)[cells.feature[at]]) / scale

        gl, hl = left(hist[0]), left(hist[1]) if len(hist) == 3 else nl[at]
        total_g, total_h = total_g / scale, totals[1] / scale if len(hist) == 3 else total_rows
        gr, hr = total_g - gl, total_h - hl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl * gl / (hl + p.lambda_l2) + gr * gr / (hr + p.lambda_l2) - total_g * total_g / (total_h + p.lambda_l2)
        gain = np.where(np.minimum(hl, hr) >= p.min_child_weight, gain, -np.inf)
        best = gain.argmax()
        gains[i], cells_at[i] = gain[best], at[best]
    return gains, cells_at


@dataclass
class Best:
    """Per node the best split among some features: gain, feature, bin, and the sums left of it (layer, node)."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray

    @classmethod
    def of_all(cls, parts: list[Best]) -> Best:
        """The best of several sets of features, given by ascending features; of equal gains the first."""
        at, node = np.argmax([p.gain for p in parts], axis=0), np.arange(len(parts[0].gain))
        gain, feature, bin_ = (np.stack([getattr(p, k) for p in parts])[at, node] for k in ("gain", "feature", "bin"))
        return cls(gain, feature, bin_, np.stack([p.left for p in parts])[at, :, node].T)


@dataclass
class Sums:
    """Asks for the histograms (layer, node, cell) of the rows in the bag that lie in ``nodes``."""

    nodes: list[int]


@dataclass
class Moved:
    """Says which nodes were split: (node, feature, bin, left child, right child)."""

    splits: list[tuple[int, int, int, int, int]]


def growing(p: BoostParams, cells: Cells, round_: int, scale: float, first: int = 0, features: int | None = None) -> Generator[Sums | Best | Moved, np.ndarray | Best | None, Tree]:
    """One tree, from the histograms of the ``cells`` of the features from ``first`` on, out of ``features`` ones.

    Yields ``Sums`` for histograms, ``Best`` among its own features for the best among all, and ``Moved`` after a level's splits."""
    features = len(cells.sizes) if features is None else features
    tree, allowed, enough = Tree(), features_of(p, features, round_)[first:first + len(cells.sizes)], 2 * max(1, p.min_data_in_leaf)

    def settle(node: int, sums: np.ndarray) -> None:
        """A leaf's value and rows from the sums of its layers."""
        h = sums[1] / scale if len(sums) == 3 else sums[-1]
        tree.value[node] = float(-sums[0] / scale / (h + p.lambda_l2) * p.learning_rate) if h + p.lambda_l2 > 0 else 0.0
        tree.rows[node] = int(sums[-1])

    level = {0: (yield Sums([0]))[:, 0]}
    settle(0, level[0][:, :cells.sizes[0]].sum(axis=1))  # any feature's cells hold all rows
    leaves, deepest = 1, p.max_depth if p.max_depth > 0 else DEEPEST
    for depth in range(1, deepest + 1):
        nodes = sorted(level)
        if not nodes:
            break
        gains, at = best_splits([level[n] for n in nodes], cells, p, allowed, scale)
        own = cells.feature[at]
        best = yield Best(gains, own + first, at - cells.starts[own], np.stack([level[n][:, cells.starts[f]:a + 1].sum(axis=1) for n, f, a in zip(nodes, own, at, strict=True)], axis=1))
        chosen = [i for i in np.argsort(-best.gain, kind="stable") if best.gain[i] > 1e-10][:p.num_leaves - leaves]
        leaves += len(chosen)
        ends, sides, splits = leaves >= p.num_leaves or depth == deepest, [], []
        for i in sorted(chosen):
            n = nodes[i]
            whole, part = level[n][:, :cells.sizes[0]].sum(axis=1), best.left[:, i]
            a, b = tree.split(n, int(best.feature[i]), int(best.bin[i]), float(best.gain[i]))
            settle(a, part)
            settle(b, whole - part)
            splits.append((n, tree.feature[n], tree.bin[n], a, b))
            if not ends and max(tree.rows[a], tree.rows[b]) >= enough:
                sides.append((n, a, b) if tree.rows[a] <= tree.rows[b] else (n, b, a))
        yield Moved(splits)
        found = (yield Sums([small for _, small, _ in sides])) if sides else None
        level = {child: hist for i, (n, small, large) in enumerate(sides)
                 for child, hist in ((small, found[:, i]), (large, level[n] - found[:, i])) if tree.rows[child] >= enough}
    return tree


class Rows:
    """A fit's rows by the node they lie in, where a task has all features of all rows, or some of them.

    Where it has some, a level's splits move rows by one bit a row, made by the task that has the split's feature."""

    def __init__(self, block: Block, y: np.ndarray, role: np.ndarray, margin: np.ndarray, p: BoostParams, scale: float, first: int = 0, features: int | None = None):
        self.block, self.y, self.role, self.margin, self.p, self.scale, self.first, self.features = block, y, role, margin, p, scale, first, features
        self.used, self.held, self.tree, self.draw = np.flatnonzero(role > 0), np.flatnonzero(role == 2), None, None

    def begin(self, round_: int) -> Sums:
        draw = round_ // self.p.bagging_freq if self.p.bagging_freq > 0 else 0
        if self.draw != draw:
            self.draw, self.bag = draw, (self.role == 1) & in_bag(self.p, self.block.ids, round_)
            self.drawn, self.rows_of = np.flatnonzero(self.bag), None
        self.weights, self.of = gradients(self.p, self.y, self.margin, self.scale), {0: self.used}
        self.growth = growing(self.p, self.block.cells, round_, self.scale, self.first, self.features)
        return next(self.growth)

    def until_shared(self, said: Sums | Best | Moved) -> Best | Moved | None:
        """Serves the growth until it needs what other tasks know; None at its end."""
        while isinstance(said, Sums):
            said = self.send(self.sums(said.nodes))
        return said

    def send(self, value: np.ndarray | Best | None) -> Sums | Best | Moved | None:
        try:
            return self.growth.send(value)
        except StopIteration as end:
            self.tree = end.value
            return None

    def sums(self, nodes: list[int]) -> np.ndarray:
        if nodes != [0]:
            return self.block.sums([r[self.bag[r]] for r in (self.of[n] for n in nodes)], self.weights)
        out = self.block.sums([self.drawn], self.weights, self.rows_of)
        self.rows_of = out[-1, 0]  # the same for all rounds of a draw
        return out

    def step(self, round_: int) -> Round:
        """A tree by a task that has all features."""
        said = self.until_shared(self.begin(round_))
        while said is not None:
            if isinstance(said, Moved):
                for n, f, at, a, b in said.splits:
                    rows = self.of.pop(n)
                    left = self.block.goes_left(rows, f, at)
                    self.of[a], self.of[b] = rows[left], rows[~left]
            said = self.until_shared(self.send(said if isinstance(said, Best) else None))
        return self.end()

    def bits(self, moved: Moved) -> dict[int, bytes]:
        """Which rows go left, for the splits on own features."""
        return {n: np.packbits(self.block.goes_left(self.of[n], f - self.first, at)).tobytes()
                for n, f, at, _, _ in moved.splits if self.first <= f < self.first + len(self.block.cells.sizes)}

    def move(self, moved: Moved, bits: dict[int, bytes]) -> None:
        for n, _, _, a, b in moved.splits:
            rows = self.of.pop(n)
            left = np.unpackbits(np.frombuffer(bits[n], np.uint8), count=len(rows)).view(bool)
            self.of[a], self.of[b] = rows[left], rows[~left]

    def end(self) -> Round:
        for node, rows in self.of.items():
            self.margin[rows] += self.tree.value[node]
        return Round(self.tree, float(losses(self.p, self.y[self.held], self.margin[self.held]).sum()))


def grown_together(fits: list[Rows], round_: int, share: Callable[[list], list[list]]) -> list[Round]:
    """A tree of every fit, level by level side by side. ``share`` gives what every task has passed to it, in the order of their features."""
    said = [f.until_shared(f.begin(round_)) for f in fits]
    while open_ := [i for i, s in enumerate(said) if s is not None]:
        others = share([s if isinstance(s, Best) else fits[i].bits(s) for i in open_ for s in [said[i]]])
        for at, i in enumerate(open_):
            own, fit = [o[at] for o in others], fits[i]
            if isinstance(said[i], Best):
                said[i] = fit.until_shared(fit.send(Best.of_all(own)))
            else:
                fit.move(said[i], {n: b for bits in own for n, b in bits.items()})
                said[i] = fit.until_shared(fit.send(None))
    return [f.end() for f in fits]


@dataclass
class Round:
    tree: Tree
    loss: float


def base_margin(p: BoostParams, mean: float) -> float:
    """What a fit starts from: the mean target, or the log-odds of the weighted share of positives."""
    if not p.binary:
        return mean
    mean = min(1 - 1e-9, max(1e-9, mean))
    return float(np.log(mean / (1 - mean)))


def scale_of(p: BoostParams, rows: int, largest: float) -> float:
    """A power of two so that sums over ``rows`` gradients up to ``largest`` stay whole numbers in a double."""
    return float(2.0 ** np.floor(51 - np.log2(max(1.0, rows) * max(1.0, largest * (p.scale_pos_weight if p.binary else 1.0)))))


def rounds_of_one_block(block: Block, p: BoostParams, margin: np.ndarray, scale: float, first: int, rounds: int) -> Iterator[Round]:
    """``rounds`` more rounds of a fit whose rows are one block; ``margin`` is moved along."""
    rows = Rows(block, block.y, np.where(block.held, 2, 1), margin, p, scale)
    for round_ in range(first, first + rounds):
        yield rows.step(round_)
