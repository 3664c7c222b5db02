"""Boosted-tree fits on Spark: binned rows, concurrent fits, stored and resumable progress.

* ``Bins`` turns feature columns into one byte each: null is bin 0, values are cut at
  edges chosen from a bounded sample of rows, columns side by side;
* rows with bins, targets and roles (not used, trained on, held out - one each per fit)
  are packed into blocks of at most ``trees.BLOCK_ROWS`` rows and stored once, and their
  bins once more as bundles of features (``trees.Bundle``); all fits of a call share them;
* fits come in groups that stop together (a fold or a bag alone; the folds of a grid
  point on their mean error): after ``early_stopping_rounds`` rounds without a lower
  held-out error. Groups run at once. Up to ``trees.TASK_ROWS`` rows a task holds all of
  them for the groups it has, one after the other; beyond, the tasks of a barrier job hold
  some features of all rows each and grow all fits level by level, and only best splits
  and a bit a row and level meet;
* after every ``CHUNK`` rounds the trees and the rows' margins are written to the store. A fit that has not ended goes on from there, in this
  process or a later one; no tree is made twice, and the model is the one of a single
  run (gradients are summed as whole numbers, draws depend on row ids and rounds only);
* a store entry is named by the content of its rows, the parameters and the code of
  the fits, so other data or parameters never meet it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators import trees as T
from ..operators.trees import Block, BoostParams, Cells, Tree
from ..session import code_digest, finished, store_entry

KEYS = ["slip", "user_id"]
#: Rounds after which progress is stored.
CHUNK = 50
#: Rows, counted once per fit, whose margins a task holds at once where the rows are many blocks.
WAVE = 1 << 22

_TREE = "struct<round:int,loss:double,feature:array<int>,bin:array<int>,left:array<int>,right:array<int>,value:array<double>,gain:array<double>,rows:array<long>>"
_PROGRESS = f"member int, margin binary, rounds array<{_TREE}>"
_MARGINS = f"member int, block long, margin binary, rounds array<{_TREE}>"
_BLOCK = "block long, n int, bins binary, ids binary, y binary, role binary"
_BUNDLE = "span int, first int, features int, patterns binary, codes binary"
_START = "member int, base double, scale double, held double, blocks string, bundles string, spans int"
#: Features that a task makes bundles of at least, where any task may have all of them.
SPAN = 64


# ---- bins ----------------------------------------------------------------

def edges_of(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """Upper ends of at most ``most`` bins over ascending values: frequent values get bins of their own, the rest about equal ones."""
    if len(values) <= most:
        return [float(v) for v in values[:-1]]
    out, left, rows, own = [], most, counts.sum(), 0.0
    for i, c in enumerate(counts[:-1]):
        own += c
        mean = rows / left
        heavy_next = counts[i + 1] >= mean
        if own >= mean or heavy_next and own >= mean / 2:
            out.append(float(values[i]))
            rows, own, left = rows - own, 0.0, left - 1
            if left == 1:
                break
    return out


@dataclass
class Bins:
    columns: list[str]
    edges: list[list[float]] = field(default_factory=list)

    def fit(self, df: DataFrame, max_bin: int, sample: int = 200_000) -> Bins:
        """Edges from the values of about ``sample`` rows (all, if there are no more), 32 columns in a task; nulls have the bin before the first."""
        if not 3 <= max_bin <= 255:
            raise ValueError("between 3 and 255 bins")
        n, width = df.count(), len(self.columns)
        if n > sample:
            df = df.where(F.pmod(F.xxhash64(F.lit("bins"), *KEYS), F.lit(1 << 30)) < int(sample / n * (1 << 30)))

        def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [c.drop_null().to_numpy(zero_copy_only=False).astype(float).tobytes() for c in batch.columns]
                yield pa.RecordBatch.from_pydict({"group": pa.array([i // 32 for i in range(width)], pa.int32()), "at": pa.array(range(width), pa.int32()), "values": pa.array(own, pa.binary())})

        def edges(key, table):
            parts: dict[int, list[bytes]] = {}
            for at, values in zip(table.column("at").to_pylist(), table.column("values").to_pylist(), strict=True):
                parts.setdefault(at, []).append(values)
            out = []
            for own in parts.values():
                values, counts = np.unique(np.frombuffer(b"".join(own)), return_counts=True)
                out.append(edges_of(values, counts, max_bin - 1) if len(values) else [])
            return pa.table({"at": pa.array(list(parts), pa.int32()), "edges": pa.array(out, pa.list_(pa.float64()))})

        values = df.select(*[F.col(f"`{c}`") for c in self.columns]).mapInArrow(columns, "group int, at int, values binary")
        found = {r.at: list(r.edges) for r in values.groupBy("group").applyInArrow(edges, "at int, edges array<double>").collect()}
        self.edges = [found.get(i, []) for i in range(width)]
        return self

    @property
    def cells(self) -> Cells:
        return Cells(np.array([len(e) + 2 for e in self.edges]))

    def binned(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns with ``bins``, a byte per feature column."""
        rows = df.select(*[F.col(f"`{c}`") for c in [*keep, *self.columns]])
        schema = StructType([*rows.schema.fields[:len(keep)], *StructType.fromDDL("bins binary").fields])
        arrow, edges, n = to_arrow_schema(schema), [np.array(e) for e in self.edges], len(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = np.zeros((batch.num_rows, len(edges)), np.uint8)
                for i, e in enumerate(edges):
                    column = batch.column(n + i)
                    values = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                    out[:, i] = np.where(np.isnan(values), 0, np.searchsorted(e, values) + 1)
                yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns[:n], arrow, strict=False)], _bytes(out)], schema=arrow)

        return rows.mapInArrow(run, schema)

    def with_column(self, name: str, edges: list[float]) -> Bins:
        return Bins([*self.columns, name], [*self.edges, edges])


def _bytes(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as a binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows x ``width`` bytes of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


# ---- fits ----------------------------------------------------------------

@dataclass
class Fit:
    """One model to make: its target and the role of every row (0 not used, 1 trained on, 2 held out)."""

    name: str
    params: BoostParams
    target: Column
    role: Column


@dataclass
class Model:
    """A fitted model: rows start at ``base`` and every tree adds the value of their leaf."""

    name: str
    params: BoostParams
    base: float
    trees: list[Tree]
    losses: list[float]

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        margin = np.full(len(bins), self.base)
        for tree in self.trees:
            margin += tree.predicted(bins)
        return 1 / (1 + np.exp(-margin)) if self.params.binary else margin


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """The round of least error before ``patience`` rounds without a lower one, and whether those were seen."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass
class Layout:
    """Which of the rows' distinct targets and roles each fit has."""

    targets: list[Column]
    roles: list[Column]
    of: list[tuple[int, int]]

    @classmethod
    def made(cls, fits: list[Fit]) -> Layout:
        targets, roles = ({str(c): c for c in cs} for cs in ([f.target for f in fits], [f.role for f in fits]))
        return cls(list(targets.values()), list(roles.values()), [(list(targets).index(str(f.target)), list(roles).index(str(f.role))) for f in fits])

    def rows(self, rows: DataFrame) -> DataFrame:
        """What fits read of the rows: bins, an id, the targets and the roles."""
        return rows.select("bins", F.xxhash64(*KEYS).alias("id"), F.array(*[c.cast("double") for c in self.targets]).alias("y"),
                           F.array(*[c.cast("int") for c in self.roles]).alias("role"))

    @property
    def shape(self) -> Shape:
        return Shape(len(self.targets), len(self.roles), self.of)


@dataclass
class Shape:
    """How a stored block is read: the numbers of targets and roles, and those of each fit."""

    targets: int
    roles: int
    of: list[tuple[int, int]]

    def target_and_role(self, row: dict, member: int) -> tuple[np.ndarray, np.ndarray]:
        """A fit's targets (a missing one is 0) and roles."""
        t, r = self.of[member]
        return np.nan_to_num(np.frombuffer(row["y"], float).reshape(-1, self.targets)[:, t]), np.frombuffer(row["role"], np.uint8).reshape(-1, self.roles)[:, r]


def packed(columns: DataFrame, n: int, shape: Shape, width: int) -> DataFrame:
    """``columns`` (bins, id, y, role) of ``n`` rows as blocks."""
    parts = -(-n // T.BLOCK_ROWS)
    most = T.BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, made, task = 0, 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal held, size, made
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("id").to_numpy()
            y = np.array(table.column("y").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, shape.targets)
            role = table.column("role").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(-1, shape.roles)
            bins = _matrix(table.column("bins").combine_chunks(), width)
            held, size, made = [], 0, made + 1
            return pa.RecordBatch.from_pydict({"block": pa.array([task * 2 ** 20 + made], pa.int64()), "n": pa.array([len(ids)], pa.int32()), "bins": [bins.tobytes()], "ids": [ids.tobytes()], "y": [y.tobytes()], "role": [role.tobytes()]})

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - size)
                held.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == most:
                    yield flush()
        if size:
            yield flush()

    return columns.repartition(parts).mapInArrow(run, _BLOCK)


def _spans(width: int, parts: int) -> list[tuple[int, int]]:
    """``width`` features in ``parts`` runs."""
    return [(width * i // parts, width * (i + 1) // parts) for i in range(parts)]


def bundled(spark: SparkSession, blocks: DataFrame, cells: Cells, parts: int) -> DataFrame:
    """The bundles of features of all rows, in the order of the blocks; a task has one of ``parts`` spans of features."""
    seats, spans, sizes = _seats(spark, parts), _spans(len(cells.sizes), parts), cells.sizes
    every = {seat: i for i, seat in enumerate(seats)}
    kept = "block long, n int, bins binary, seat int"
    arrow_kept, arrow = to_arrow_schema(StructType.fromDDL(kept)), to_arrow_schema(StructType.fromDDL(_BUNDLE))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], -1)
                for seat, i in every.items():
                    own = np.ascontiguousarray(bins[:, slice(*spans[i])].T).tobytes()
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "n": row["n"], "bins": own, "seat": seat}], schema=arrow_kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda r: r["block"])
        if len({r["seat"] for r in rows}) != 1:
            raise RuntimeError("a task needs the rows of one set of features")
        span = every[rows[0]["seat"]]
        first, end = spans[span]
        columns = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(end - first, r["n"]) for r in rows], axis=1)
        del rows
        for b in T.bundles(columns, sizes[first:end], first):
            yield pa.RecordBatch.from_pylist([{"span": span, "first": b.first, "features": b.patterns.shape[1], "patterns": b.patterns.tobytes(), "codes": b.codes.tobytes()}], schema=arrow)

    return blocks.select("block", "n", "bins").mapInArrow(slices, kept).repartition(parts, "seat").mapInArrow(run, _BUNDLE)


def _bundles_of(rows: list[dict]) -> list[T.Bundle]:
    """Bundles from their stored rows, from left to right."""
    return [T.Bundle(r["first"], np.frombuffer(r["patterns"], np.uint8).reshape(-1, r["features"]), np.frombuffer(r["codes"], np.uint16)) for r in sorted(rows, key=lambda r: r["first"])]


@dataclass
class Start:
    """What a fit begins with, from sums over its rows."""

    base: float
    scale: float
    held: int  # rows (weighted) that the error is a mean over


def starts_of(blocks: DataFrame, fits: list[Fit], shape: Shape) -> list[Start]:
    """Base, scale and held-out weight of every fit, from one pass over the blocks."""
    params = [f.params for f in fits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out: dict = {"member": [], "rows": [], "weight": [], "total": [], "largest": [], "held": []}
                for m, p in enumerate(params):
                    value, role = shape.target_and_role(row, m)
                    train = role == 1
                    w = T.weight_of(p, value)
                    target = (value > 0) if p.binary else value
                    for name, v in (("member", m), ("rows", int((role > 0).sum())), ("weight", float(w[train].sum())),
                                    ("total", int(np.rint(w[train] * target[train] * 2 ** 20).sum())), ("largest", float(np.abs(target).max(initial=0))),
                                    ("held", float(w[role == 2].sum()))):
                        out[name].append(v)
                yield pa.RecordBatch.from_pydict({"member": pa.array(out["member"], pa.int32()), "rows": pa.array(out["rows"], pa.int64()), "weight": out["weight"],
                                                  "total": pa.array(out["total"], pa.int64()), "largest": out["largest"], "held": out["held"]})

    sums = blocks.mapInArrow(run, "member int, rows long, weight double, total long, largest double, held double").groupBy("member").agg(
        F.sum("rows").alias("rows"), F.sum("weight").alias("weight"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.max("largest").alias("largest"), F.sum("held").alias("held"))
    by = {r.member: r for r in sums.collect()}
    out = []
    for m, p in enumerate(params):
        r = by[m]
        mean = int(r.total) / 2 ** 20 / r.weight if r.weight else 0.0
        out.append(Start(T.base_margin(p, mean), T.scale_of(p, r.rows, r.largest + abs(mean)), r.held))
    return out


def _recorded(rounds: list[tuple[int, T.Round]]) -> list[dict]:
    return [{"round": i, "loss": r.loss, **{k: getattr(r.tree, k) for k in ("feature", "bin", "left", "right", "value", "gain", "rows")}} for i, r in rounds]


def _tree(row) -> Tree:
    return Tree(*[list(row[k]) for k in ("feature", "bin", "left", "right", "value", "gain", "rows")])


@dataclass
class _Group:
    """Fits that stop together, and how far they are: the mean held-out error after each round."""

    members: list[int]
    patience: int
    bound: int
    errors: list[float] = field(default_factory=list)

    @property
    def ended(self) -> bool:
        return len(self.errors) >= self.bound or best_round(self.errors, self.patience)[1]


@dataclass
class Fits:
    """All fits of a call over one set of rows."""

    spark: SparkSession
    models: dict[str, Model]
    errors: dict[str, list[float]]  # of each group, named by its first fit: the mean held-out error up to the best round
    chunks: list[str]
    made: int  # chunks that this call made itself

    def nodes(self) -> DataFrame:
        """The written trees as a table: fit, round, node, feature (-1 at leaves), bin, value, gain, rows; rounds after the best ones left out."""
        names = self.spark.createDataFrame([(i, m.name, len(m.trees)) for i, m in enumerate(self.models.values())], "member int, fit string, best int")
        flat = self.spark.read.schema(_PROGRESS).parquet(*self.chunks).select("member", F.explode("rounds").alias("r"))
        flat = flat.select("member", "r.round", F.posexplode(F.arrays_zip("r.feature", "r.bin", "r.value", "r.gain", "r.rows")).alias("node", "n"))
        return flat.join(F.broadcast(names), "member").where("round < best").select("fit", "round", "node", "n.feature", "n.bin", "n.value", "n.gain", "n.rows")


def fit_groups(rows: DataFrame, bins: Bins, groups: list[list[Fit]]) -> Fits:
    """Fits all groups on ``rows`` (slip, user_id, bins, and what targets and roles read); stored progress is taken up."""
    spark, fits = rows.sparkSession, [f for g in groups for f in g]
    cells, layout = bins.cells, Layout.made(fits)
    shape, columns = layout.shape, layout.rows(rows)
    content = F.xxhash64("bins", "id", "y", "role")
    seen = columns.agg(F.count(F.lit(1)).alias("n"), F.sum(content.cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64(content)).alias("xor")).first()
    if not seen.n:
        raise ValueError("no rows to fit on")
    identity = [seen.n, str(seen["sum"]), seen["xor"], cells.sizes.tolist(), shape.of, [[f.params.record() for f in g] for g in groups], code_digest()]
    path = store_entry(spark, "fits-" + hashlib.sha256(json.dumps(identity).encode()).hexdigest()[:32])
    entry = finished(spark, path, "start-")
    if not entry:
        blocks_path = f"{path}/blocks-{uuid.uuid4().hex}"
        packed(columns, seen.n, shape, len(bins.edges)).write.parquet(blocks_path)
        made_blocks, bundles_path, width = spark.read.schema(_BLOCK).parquet(blocks_path), f"{path}/bundles-{uuid.uuid4().hex}", len(cells.sizes)
        spans = max(1, min(spark.sparkContext.defaultParallelism, width // SPAN if seen.n <= T.TASK_ROWS else width))
        bundled(spark, made_blocks, cells, spans).write.parquet(bundles_path)
        begun = starts_of(made_blocks, fits, shape)
        spark.createDataFrame([(m, s.base, s.scale, float(s.held), blocks_path, bundles_path, spans) for m, s in enumerate(begun)], _START).write.parquet(f"{path}/start-{uuid.uuid4().hex}")
        entry = finished(spark, path, "start-")
    saved = spark.read.schema(_START).parquet(entry[0]).orderBy("member").collect()
    chunk_of = f"chunk-{entry[0].rpartition('-')[2]}-"  # margins are in the order of this start's blocks: another process may have made its own
    starts, blocks, bundles = [Start(r.base, r.scale, r.held) for r in saved], spark.read.schema(_BLOCK).parquet(saved[0].blocks).drop("bins"), spark.read.schema(_BUNDLE).parquet(saved[0].bundles)

    members = iter(range(len(fits)))
    state = [_Group([next(members) for _ in g], g[0].params.early_stopping_rounds, g[0].params.num_boost_round) for g in groups]
    rounds: list[list] = [[] for _ in fits]
    chunks: list[str] = []
    made = 0
    while True:
        found = finished(spark, path, f"{chunk_of}{len(chunks):05d}-")
        if not found:
            if all(g.ended for g in state):
                break
            made += 1
            if seen.n <= T.TASK_ROWS:
                progress = _together(spark, blocks, bundles, chunks, fits, shape, cells, starts, state)
            else:
                past = finished(spark, path, f"margins-{chunk_of}{len(chunks) - 1:05d}-")
                margins = f"{path}/margins-{chunk_of}{len(chunks):05d}-{uuid.uuid4().hex}"
                _blockwise(spark, blocks, bundles, saved[0].spans, spark.read.schema(_MARGINS).parquet(past[0]) if chunks else None, seen.n, fits, shape, cells, starts, state).write.parquet(margins)
                progress = spark.read.schema(_MARGINS).parquet(margins).where("rounds IS NOT NULL").select("member", F.lit(None).cast("binary").alias("margin"), "rounds")
            progress.write.parquet(f"{path}/{chunk_of}{len(chunks):05d}-{uuid.uuid4().hex}")
            found = finished(spark, path, f"{chunk_of}{len(chunks):05d}-")
        chunks.append(found[0])
        for r in spark.read.schema(_PROGRESS).parquet(found[0]).select("member", "rounds").where(F.size("rounds") > 0).collect():
            rounds[r.member] += r.rounds
        for g in state:
            for i in range(len(g.errors), min(len(rounds[m]) for m in g.members)):
                g.errors.append(_mean_error(starts, g, {m: rounds[m][i].loss for m in g.members}))
    models, errors = {}, {}
    for g in state:
        best = best_round(g.errors, g.patience)[0]
        errors[fits[g.members[0]].name] = g.errors[:best]
        for m in g.members:
            models[fits[m].name] = Model(fits[m].name, fits[m].params, starts[m].base, [_tree(r) for r in rounds[m][:best]], [r.loss / 2 ** 20 / max(1.0, starts[m].held) for r in rounds[m][:best]])
    return Fits(spark, models, errors, chunks, made)


def _mean_error(starts: list[Start], g: _Group, loss: dict[int, float]) -> float:
    """The mean over a group's fits of their held-out error."""
    return sum(loss[m] / 2 ** 20 / max(1.0, starts[m].held) for m in g.members) / len(g.members)


def _advance(g: _Group, running: dict[int, T.Rows], starts: list[Start], rounds: int) -> dict[int, list]:
    """Up to ``rounds`` more rounds of a group's fits, side by side, until their patience ends."""
    errors, made = list(g.errors), {m: [] for m in g.members}
    for round_ in range(len(errors), min(g.bound, len(errors) + rounds)):
        if best_round(errors, g.patience)[1]:
            break
        for m, fit in running.items():
            made[m].append((round_, fit.step(round_)))
        errors.append(_mean_error(starts, g, {m: made[m][-1][1].loss for m in g.members}))
    return made


def _in_blocks(rows: list[dict]) -> tuple[list[dict], np.ndarray]:
    """The rows that are blocks, in their order, and their ids."""
    held = sorted((r for r in rows if r["block"] is not None and r["member"] is None), key=lambda r: r["block"])
    return held, np.concatenate([np.frombuffer(r["ids"], np.int64) for r in held])


def _together(spark: SparkSession, blocks: DataFrame, bundles: DataFrame, chunks: list[str], fits: list[Fit], shape: Shape, cells: Cells, starts: list[Start], state: list[_Group]) -> DataFrame:
    """Up to ``CHUNK`` more rounds of every group that has not ended; a task holds all rows for several groups in turn."""
    todo = [i for i, g in enumerate(state) if not g.ended]
    parts = max(1, min(spark.sparkContext.defaultParallelism, len(todo)))
    turns, seats = [todo[i::parts] for i in range(parts)], _seats(spark, parts)
    every = {seat: i for i, seat in enumerate(seats)}
    work = blocks.unionByName(bundles, allowMissingColumns=True).select("*", F.explode(F.array(*[F.lit(s) for s in seats])).alias("seat"))
    if chunks:
        seat_of = F.element_at(F.create_map(*[F.lit(x) for seat, own in zip(seats, turns, strict=True) for i in own for m in state[i].members for x in (m, seat)]), F.col("member"))
        kept = spark.read.schema(_PROGRESS).parquet(chunks[-1]).select("member", "margin", seat_of.alias("seat")).where("seat IS NOT NULL")
    else:
        kept = spark.createDataFrame([], "member int, margin binary, seat int")
    work = work.unionByName(kept, allowMissingColumns=True)
    params, rounds = [f.params for f in fits], CHUNK
    shared = spark.sparkContext.broadcast({"cells": cells.sizes, "starts": starts, "state": state})
    arrow = to_arrow_schema(StructType.fromDDL(_PROGRESS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = shared.value, [row for batch in batches for row in batch.to_pylist()]
        seat = {r["seat"] for r in rows}
        if len(seat) != 1:
            raise RuntimeError("a task needs the groups of one seat")
        saved = {r["member"]: np.frombuffer(r["margin"], float) for r in rows if r["member"] is not None}
        held, ids = _in_blocks(rows)
        block = Block(_bundles_of([r for r in rows if r["codes"] is not None]), ids, np.zeros(0), np.zeros(0, bool), Cells(own["cells"]))
        del rows

        def started(m: int) -> T.Rows:
            y, role = (np.concatenate(x) for x in zip(*(shape.target_and_role(r, m) for r in held), strict=True))
            margin = saved.pop(m).copy() if m in saved else np.full(len(y), own["starts"][m].base)
            return T.Rows(block, y, role, margin, params[m], own["starts"][m].scale)

        for i in turns[every[seat.pop()]]:
            g = own["state"][i]
            running = {m: started(m) for m in g.members}
            made = _advance(g, running, own["starts"], rounds)
            for m, fit in running.items():
                yield pa.RecordBatch.from_pylist([{"member": m, "margin": fit.margin.tobytes(), "rounds": _recorded(made[m])}], schema=arrow)

    return work.repartition(parts, "seat").mapInArrow(run, _PROGRESS)


def _seats(spark: SparkSession, parts: int) -> list[int]:
    """A key for each of ``parts`` partitions that a repartition by it deals there."""
    at = F.pmod(F.hash("id"), F.lit(parts))
    found = {r.at: r.id for r in spark.range(64 * parts).select(F.col("id").cast("int").alias("id")).groupBy(at.alias("at")).agg(F.min("id").alias("id")).collect()}
    return [found[i] for i in range(parts)]


def _blockwise(spark: SparkSession, blocks: DataFrame, bundles: DataFrame, parts: int, margins: DataFrame | None, n: int, fits: list[Fit], shape: Shape, cells: Cells, starts: list[Start], state: list[_Group]) -> DataFrame:
    """The same where the rows are too many for a task. The tasks run side by side (barrier mode), each with one of ``parts``
    spans of features of all rows: they tell each other the best splits and one bit a row and level, and all move the margins along.

    Gives a row per fit with its rounds, and one per fit and block with the margins."""
    todo, width = [i for i, g in enumerate(state) if not g.ended], len(cells.sizes)
    spans, params, rounds, seats = _spans(width, parts), [f.params for f in fits], CHUNK, _seats(spark, parts)
    every = {seat: i for i, seat in enumerate(seats)}
    to_all = F.explode(F.array(*[F.lit(s) for s in seats])).alias("seat")
    own_seat = F.element_at(F.array(*[F.lit(s) for s in seats]), F.col("span") + 1)
    work = blocks.select("*", to_all).unionByName(bundles.withColumn("seat", own_seat), allowMissingColumns=True)
    kept = margins.where(F.col("margin").isNotNull()).select("block", "member", "margin", to_all) if margins is not None else spark.createDataFrame([], "block long, member int, margin binary, seat int")
    work = work.unionByName(kept, allowMissingColumns=True)
    wave = max(1, WAVE // n)
    shared = spark.sparkContext.broadcast({"cells": cells.sizes, "starts": starts, "state": state})
    arrow = to_arrow_schema(StructType.fromDDL(_MARGINS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        rows = [row for batch in batches for row in batch.to_pylist()]
        saved = {(r["member"], r["block"]): r["margin"] for r in rows if r["member"] is not None}
        seat = {r["seat"] for r in rows}
        if len(seat) != 1:
            raise RuntimeError("a task needs the rows of one set of features")
        part = every[seat.pop()]
        first, end = spans[part]
        held, ids = _in_blocks(rows)
        ends = np.cumsum([r["n"] for r in held])
        block = Block(_bundles_of([r for r in rows if r["codes"] is not None]), ids, np.zeros(0), np.zeros(0, bool), Cells(own["cells"][first:end]))
        del rows

        def share(value: list) -> list[list]:
            said = BarrierTaskContext.get().allGather(base64.b64encode(pickle.dumps((part, value))).decode())
            return [v for _, v in sorted((pickle.loads(base64.b64decode(s)) for s in said), key=lambda x: x[0])]

        def started(m: int) -> T.Rows:
            y, role = (np.concatenate(x) for x in zip(*(shape.target_and_role(r, m) for r in held), strict=True))
            begin = own["starts"][m]
            margin = np.concatenate([np.frombuffer(saved[m, r["block"]], float) for r in held]) if saved else np.full(len(y), begin.base)
            return T.Rows(block, y, role, margin, params[m], begin.scale, first, width)

        groups = [own["state"][i] for i in todo]
        while groups:
            now, groups = groups[:_in_wave(groups, wave)], groups[_in_wave(groups, wave):]
            running = {m: started(m) for g in now for m in g.members}
            made = _advance_side_by_side(now, running, own["starts"], rounds, share)
            if part == 0:
                for m, fit in running.items():
                    yield pa.RecordBatch.from_pylist([{"member": m, "block": None, "margin": None, "rounds": _recorded(made[m])}], schema=arrow)
                    for r, b in zip(held, ends, strict=True):
                        yield pa.RecordBatch.from_pylist([{"member": m, "block": r["block"], "margin": fit.margin[b - r["n"]:b].tobytes(), "rounds": None}], schema=arrow)

    return work.repartition(parts, "seat").mapInArrow(run, _MARGINS, barrier=True)


def _in_wave(groups: list[_Group], most: int) -> int:
    """The first groups that have at most so many fits together; one at least."""
    return max(1, int(np.searchsorted(np.cumsum([len(g.members) for g in groups]), most, side="right")))


def _advance_side_by_side(groups: list[_Group], running: dict[int, T.Rows], starts: list[Start], rounds: int, share) -> dict[int, list]:
    """Up to ``rounds`` more rounds of several groups, whose fits all tasks grow together."""
    errors, made = [list(g.errors) for g in groups], {m: [] for g in groups for m in g.members}
    for _ in range(rounds):
        going = [(g, e) for g, e in zip(groups, errors, strict=True) if len(e) < g.bound and not best_round(e, g.patience)[1]]
        for round_ in sorted({len(e) for _, e in going}):  # all groups of a call are at the same round
            own = [(g, e) for g, e in going if len(e) == round_]
            members = [m for g, _ in own for m in g.members]
            for m, r in zip(members, T.grown_together([running[m] for m in members], round_, share), strict=True):
                made[m].append((round_, r))
            for g, e in own:
                e.append(_mean_error(starts, g, {m: made[m][-1][1].loss for m in g.members}))
    return made


# ---- scoring -------------------------------------------------------------

def scored(rows: DataFrame, models: list[Model], out: str, by: str | None = None) -> DataFrame:
    """``rows`` with ``out``: the mean of the models' predictions from ``bins``, or with ``by`` that of the model this column numbers."""
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"`{out}` double").fields])
    arrow, names = to_arrow_schema(schema), rows.columns
    shared = rows.sparkSession.sparkContext.broadcast(models)
    bins_at, by_at = names.index("bins"), names.index(by) if by else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(bins_at)
            bins = _matrix(column, len(column[0].as_py()))
            if by is None:
                value = sum(m.predicted(bins) for m in shared.value) / len(shared.value)
            else:
                which, value = batch.column(by_at).to_numpy(), np.zeros(len(bins))
                for i, m in enumerate(shared.value):
                    value[which == i] = m.predicted(bins[which == i])
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)], pa.array(value)], schema=arrow)

    return rows.mapInArrow(run, schema)


def with_bin(rows: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """``rows`` with the bin of ``column`` put behind ``bins``."""
    at = sum((F.when(F.col(column) > e, 1).otherwise(0) for e in edges), F.lit(1))
    byte = F.unhex(F.lpad(F.hex(F.when(F.col(column).isNull(), 0).otherwise(at)), 2, "0"))
    return rows.withColumn("bins", F.concat("bins", byte))
