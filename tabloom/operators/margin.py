"""Linear margins (hinge loss) of many models at once.

A grid of SVMs is many binary problems over the same rows: one for each class, fold and
value of C.  Here they are the columns of one weight matrix.  The rows are packed once
into small blocks of float64 values, so that an Arrow batch of them stays far below the
bytes it may have and a task holds the same few MB whatever the input; every step reads
the blocks once, multiplies each row with the open columns that it trains, and adds up
losses, gradients and curvatures, first inside a task, then over groups of tasks, so the
driver receives a bounded number of sums whatever the number of rows or tasks.  The number of scans per step does not depend on the number of
models, and a column leaves as soon as it has converged.

Each column minimises  mean(w hinge(y (x . b + a))) + |b|^2 / (2 C n)  (intercept a not
penalised), the objective of Spark's ``LinearSVC`` with ``regParam = 1 / (C n)`` and no
standardisation.  The steps are Newton steps on a rounded hinge, a parabola where the gap is
within ``width`` of the hinge, whose width shrinks whenever a step would gain little.  Few rows
may be that near, so a step is also tried with several shares of the rows' second moments
added to the curvature (damped: it then moves the gaps less), all in the same scan, and the
best point by the true objective is kept.  A column also looks at the points
of the other values of C of its class and fold (their losses are the same, only the
penalty differs) and goes on from there if one is better: warm starts along C.

Many rows get warm starts along the rows too.  Every ``THIN``-th block, every ``THIN``-th of
those and so on are copied into small tables, and the steps begin on the smallest: from there a
column takes only its point on to the next table.  The last table is always the whole one,
where every column starts open and closes by the same rule as without these starts, so the
result is the minimum over all rows; only the number of steps over all rows is smaller.

A row takes part in a column if its ``view`` is -1 or the column's fold, and its fold is
not the column's (fold -1: all rows train).  So one table holds folds with the same
features (view -1), or each fold's own preparation of all rows (view = fold).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import cut_lineage, small_splits

#: Bytes of a stored block (an Arrow batch has up to 10,000 of them), rows worked on
#: together, and values of rows x points held at once.
BLOCK_BYTES = 2048
BLOCK_ROWS = 1024
CELLS = 1 << 15
#: Bytes of a split of the stored blocks (some seconds of work), in row groups of a few MB.
SPLIT_BYTES = 16 << 20
#: A table of starting points has one block in THIN of the next larger one, and at least
#: START_ROWS rows; a column whose class or rest has fewer than START_SIDE of them waits.
THIN = 16
START_ROWS = 1 << 17
START_SIDE = 500
#: Tasks' sums go to the driver directly up to this count, else through that many groups.
GROUPS = 64
#: Columns solved together; curvature sums of one task are bounded by BYTES.
COLUMNS = 2048
BYTES = 128 << 20
#: Tried steps: these multiples of a column's damping (and no step).
DAMPS = (0.0, 0.03, 0.3, 3.0, 30.0)
MAX_STEPS = 60
#: A column is done when two steps gain, and its rounding adds, less than this share of its
#: objective (1 at the start), or of LEAST where it is nearly 0.
TOL = 3e-4
LEAST = 1e-2
SHRINK = 0.35
#: The first width: every row is within it of the hinge (gap 1 at the start).
WIDEST = 2.0
#: sin(pi r) / r by powers of r ** 2, highest first: full accuracy for |r| <= 1/2.
SINE = [(-1) ** k * math.pi ** (2 * k + 1) / math.factorial(2 * k + 1) for k in range(9, -1, -1)]


@dataclass(frozen=True)
class FeatureMap:
    """Random Fourier features sqrt(2 / D) cos(x W + b) of the columns, or, without
    weights, the columns themselves."""

    weights: np.ndarray | None = None
    phase: np.ndarray | None = None

    def of(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return x
        out = np.empty((len(self.phase), len(x)))
        self.into(np.vstack([x.T, np.ones(len(x))]), out, self.turns())
        return out.T

    def turns(self) -> np.ndarray | None:
        """Weights and phase as parts of a full turn, a row per feature."""
        return None if self.weights is None else np.vstack([self.weights, self.phase]).T / (2.0 * math.pi)

    def into(self, x: np.ndarray, out: np.ndarray, turns: np.ndarray | None) -> None:
        """The features of ``x`` (a column per row, a last row of ones), a column per row too.
        cos(2 pi r) = 1 - 2 sin(pi r)^2 with r in [-1/2, 1/2], by whole-array products: several
        times faster than ``np.cos``, to the same 1e-15 or so."""
        if turns is None:
            out[:] = x[:-1]
            return
        r = turns @ x
        r -= np.rint(r)
        square = r * r
        np.multiply(square, SINE[0], out=out)
        out += SINE[1]
        for c in SINE[2:]:
            out *= square
            out += c
        out *= r
        out *= out
        height = math.sqrt(2.0 / len(self.phase))
        out *= -2.0 * height
        out += height

    def size(self, inputs: int) -> int:
        return inputs if self.weights is None else len(self.phase)


@dataclass(frozen=True)
class Column:
    """One binary problem: class ``positive`` against the rest."""

    positive: int
    c: float = 1.0
    fold: int = -1
    mapping: int = 0
    balanced: bool = False

    def family(self) -> tuple:
        return self.positive, self.fold, self.mapping, self.balanced


@dataclass
class Blocks:
    """Packed rows and what one scan knows of them, per (view, fold)."""

    table: DataFrame
    inputs: int
    classes: int
    counts: dict[tuple[int, int], np.ndarray]     # rows per class
    sums: dict[tuple[int, int], np.ndarray]       # sum and sum of squares per input
    starts: list[Blocks] = field(default_factory=list)   # parts of the table, smallest first

    def train(self, fold: int) -> list[tuple[int, int]]:
        return [k for k in self.counts if k[0] in (-1, fold) and (fold < 0 or k[1] != fold)]

    def rows(self) -> float:
        return float(sum(c.sum() for c in self.counts.values()))

    def class_rows(self, fold: int) -> np.ndarray:
        return sum((self.counts[k] for k in self.train(fold)), np.zeros(self.classes))

    def moments(self, fold: int) -> np.ndarray:
        return sum((self.sums[k] for k in self.train(fold)), np.zeros((2, self.inputs)))


def write_blocks(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "margin-blocks", **{"parquet.block.size": str(SPLIT_BYTES // 4)})


def pack(rows: DataFrame, features: str, label: str, classes: int, fold: str | None = None,
         view: str | None = None, write=None) -> Blocks:
    """Blocks of ``rows``: ``features`` is an array of doubles, ``label`` a class index.
    ``write`` stores the block table (``write_blocks``).  Null or NaN features raise."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():
                raise ValueError("SVM features must not be null, NaN or infinite")
            arrays = [x.reshape(n, -1), *(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int32)
                                          for i in (1, 2, 3))]
            step = max(1, BLOCK_BYTES // (sum(a.nbytes for a in arrays) // n))
            places = range(0, n, step)
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(step, n - at) for at in places], pa.int32()),
                 *(pa.array([a[at:at + step].tobytes() for at in places], pa.binary()) for a in arrays),
                 pa.array(range(done, done + len(places)), pa.int64())],
                names=["n", "x", "y", "fold", "view", "place"])
            done += len(places)

    source = rows.select(
        F.col(features), F.col(label).cast("int"), F.coalesce(F.col(fold), F.lit(-2)).cast("int") if fold
        else F.lit(-2), F.col(view).cast("int") if view else F.lit(-1))
    packed = source.mapInArrow(cut, "n int, x binary, y binary, fold binary, view binary, place long")
    blocks = _known(write(packed) if write else packed, classes)
    thin, part = THIN, blocks
    while write and part.rows() >= THIN * START_ROWS:
        part = _known(write(part.table.where(F.col("place") % thin == 0)), classes)
        blocks.starts.insert(0, part)
        thin *= THIN
    return blocks


def _known(table: DataFrame, classes: int) -> Blocks:
    """The block table with its rows per class and the sums of its inputs, by one scan."""

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for x, y, fold, view in _blocks(batches):
            both = (view.astype(np.int64) << 32) + fold
            for key in np.unique(both).tolist():
                mine = both == key
                xs = x[mine]
                add = [np.bincount(y[mine], minlength=classes).astype(float),
                       np.stack([xs.sum(0), (xs ** 2).sum(0)])]
                at = int(view[mine.argmax()]), int(fold[mine.argmax()])
                old = held.setdefault(at, [0, 0])
                held[at] = [old[0] + add[0], old[1] + add[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in held], pa.int32()), pa.array([f for _, f in held], pa.int32()),
             *(pa.array([a[i].tobytes() for a in held.values()], pa.binary()) for i in (0, 1))],
            names=["view", "fold", "counts", "sums"])

    counts, sums, inputs = {}, {}, 0
    with small_splits(table.sparkSession, SPLIT_BYTES):
        found = _tree_sum(table.mapInArrow(known, "view int, fold int, counts binary, sums binary"), ["view", "fold"],
                          ["counts", "sums"], _partitions(table))
    for r in found:
        key = (int(r["view"]), int(r["fold"]))
        counts[key] = np.frombuffer(r["counts"])
        sums[key] = np.frombuffer(r["sums"]).reshape(2, -1)
        inputs = sums[key].shape[1]
    return Blocks(table, inputs, classes, counts, sums)


def _partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def _tree_sum(parts: DataFrame, keys: list[str], sums: list[str], tasks: int) -> list[dict]:
    """Rows of ``keys`` with float64 arrays (binary) added up; above ``GROUPS`` tasks in
    groups of tasks first."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[:1].copy()
        for s in sums:
            out[s] = [sum(map(np.frombuffer, pdf[s])).tobytes()]
        return out

    if tasks > GROUPS:
        slot = parts.withColumn("slot", F.spark_partition_id() % GROUPS)
        parts = slot.groupBy("slot", *keys).applyInPandas(add, slot.schema).drop("slot")
    held: dict[tuple, dict] = {}
    for r in parts.toPandas().to_dict("records"):
        key = tuple(r[k] for k in keys)
        if key in held:
            for s in sums:
                held[key][s] = (np.frombuffer(held[key][s]) + np.frombuffer(r[s])).tobytes()
        else:
            held[key] = r
    return list(held.values())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, y, fold, view) of up to about ``BLOCK_ROWS`` rows at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.column(0).to_numpy(zero_copy_only=False)
        step = max(1, BLOCK_ROWS // int(n.max()))
        for at in range(0, batch.num_rows, step):
            x, *codes = (b"".join(c.to_pylist()) for c in batch.slice(at, step).columns[1:5])
            yield (np.frombuffer(x).reshape(int(n[at:at + step].sum()), -1),
                   *(np.frombuffer(c, np.int32) for c in codes))


@dataclass
class _Points:
    """Points to evaluate for one feature map; ``curved`` are those whose curvature is
    wanted.  ``shift`` and ``scale`` bring the mapped columns to mean 0, deviation 1."""

    mapping: FeatureMap
    shift: np.ndarray
    scale: np.ndarray
    weights: np.ndarray        # points x (size + 1), the last is the intercept
    positive: np.ndarray
    fold: np.ndarray
    width: np.ndarray
    class_weight: np.ndarray   # points x classes
    curved: np.ndarray
    size: int = field(init=False)
    turns: np.ndarray | None = field(init=False)

    def __post_init__(self):
        self.size, self.turns = len(self.shift) + 1, self.mapping.turns()

    def zeros(self) -> list[np.ndarray]:
        p, d = len(self.weights), self.size
        return [np.zeros(p), np.zeros(p), np.zeros((p, d)), np.zeros((len(self.curved), d, d))]

    def families(self) -> dict[int, list[np.ndarray]]:
        """Per fold, the points that share their class and class weights."""
        met: dict[tuple, list[int]] = {}
        for i, weight in enumerate(self.class_weight):
            met.setdefault((int(self.fold[i]), int(self.positive[i]), weight.tobytes()), []).append(i)
        out: dict[int, list[np.ndarray]] = {}
        for (fold, *_), pos in met.items():
            out.setdefault(fold, []).append(np.array(pos))
        return out

    def add(self, out: list[np.ndarray], families: dict[int, list[np.ndarray]], x, y, fold, view) -> None:
        """Adds one block; a point meets only the rows that train it, and only those are mapped."""
        rows = {f: ((view == f) | (view == -1)) & ((fold != f) | (f < 0)) for f in families}
        used = np.flatnonzero(np.logical_or.reduce(list(rows.values())))
        if not len(used):
            return
        x = np.vstack([x[used].T, np.ones(len(used))])
        z = np.empty((self.size, len(used)))
        self.mapping.into(x, z[:-1], self.turns)
        if self.turns is None:
            z[:-1] -= self.shift[:, None]
            z[:-1] /= self.scale[:, None]
        z[-1] = 1.0
        y = y[used]
        for f, groups in families.items():
            mine = np.flatnonzero(rows[f][used])
            if not len(mine):
                continue
            whole = len(mine) == len(used)
            zf, yf = (z, y) if whole else (z.take(mine, axis=1), y[mine])
            alone = len(groups) == 1 and (not whole or len(families) == 1)
            for pos in groups:
                sign = np.where(yf == self.positive[pos[0]], 1.0, -1.0)
                signed = np.multiply(zf, sign, out=zf if alone else None)
                self._family(out, pos, signed.T, self.class_weight[pos[0]][yf])

    def _family(self, out: list[np.ndarray], pos: np.ndarray, z: np.ndarray, w: np.ndarray) -> None:
        """``z``: the rows times their sign, ``w``: their weights."""
        at = {int(p): i for i, p in enumerate(self.curved)}
        width, step = self.width[pos][:, None], max(1, CELLS // len(pos))
        for start in range(0, len(z), step):
            zs, ws = z[start:start + step].T, w[start:start + step]
            gap = self.weights[pos] @ zs
            np.subtract(1.0, gap, out=gap)
            slope = gap / (2.0 * width)
            slope += 0.5
            np.clip(slope, 0.0, 1.0, out=slope)
            out[0][pos] += np.maximum(gap, 0.0) @ ws
            gap -= width
            np.maximum(gap, 0.0, out=gap)
            out[1][pos] += gap @ ws + (slope * slope) @ ws * width[:, 0]
            out[2][pos] -= (slope * ws) @ zs.T
            for j, p in enumerate(pos.tolist()):
                if p in at and (rows := np.flatnonzero((slope[j] > 0) & (slope[j] < 1))).size:
                    part = zs.take(rows, axis=1) * np.sqrt(ws[rows] / (2.0 * width[j]))
                    out[3][at[p]] += part @ part.T


def _scan(blocks: Blocks, groups: list[_Points]) -> list[list[np.ndarray]]:
    """Loss, rounded loss, gradient and curvature sums of all points: one job."""
    spark = blocks.table.sparkSession
    sent = spark.sparkContext.broadcast([{k: v for k, v in vars(g).items() if k not in ("size", "mapping", "turns")}
                                         | {"map": vars(g.mapping)} for g in groups])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = [_Points(mapping=FeatureMap(**g["map"]), **{k: v for k, v in g.items() if k != "map"})
                  for g in sent.value]
        out, families = [g.zeros() for g in points], [g.families() for g in points]
        for block in _blocks(batches):
            for g, sums, each in zip(points, out, families):
                g.add(sums, each, *block)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()),
             pa.array([np.concatenate([a.ravel() for s in out for a in s]).tobytes()], pa.binary())],
            names=["part", "sums"])

    with small_splits(spark, SPLIT_BYTES):
        rows = _tree_sum(blocks.table.mapInArrow(run, "part int, sums binary"), ["part"], ["sums"],
                         _partitions(blocks.table))
    sent.unpersist()
    flat, done, back = np.frombuffer(rows[0]["sums"]) if rows else None, 0, []
    for g in groups:
        arrays = []
        for a in g.zeros():
            arrays.append(a if flat is None else flat[done:done + a.size].reshape(a.shape).copy())
            done += a.size
        back.append(arrays)
    return back


class _Model:
    """State of one column."""

    def __init__(self, column: Column, size: int, n: float, weight: np.ndarray, scale: np.ndarray):
        self.column, self.class_weight, self.any = column, weight, n > 0
        self.penalty = np.append(1.0 / (column.c * max(1.0, n)) / scale ** 2, 0.0)
        self.best_w, self.width, self.damp, self.guess = np.zeros(size), WIDEST, 0.1, 0
        self.moments = None                     # the rows' second moments
        self.begin(1.0, False)

    def begin(self, total: float, wait: bool) -> None:
        """The next table, whose row weights add up to ``total``: on from the best point."""
        self.total, self.w, self.open = total, self.best_w, self.any and not wait
        self.best, self.rounding, self.grad, self.curve = math.inf, math.inf, None, None
        self.still, self.stuck = 0, 0

    def penalised(self, w: np.ndarray) -> float:
        return float((self.penalty * w * w).sum() / 2)

    def step(self, damp: float) -> np.ndarray:
        h = self.curve + np.diag(self.penalty + 1e-13) + (1e-9 + damp) * self.moments
        return -np.linalg.lstsq(h, self.grad, rcond=1e-13)[0]

    def aim(self) -> list[np.ndarray]:
        """Points of the next scan; curvature is taken at the ``guess``-th."""
        if self.grad is None:
            self.guess = 0
            return [self.w]
        steps = [self.step(d * self.damp) for d in DAMPS]
        if -steps[0] @ self.grad < 0.2 * self.rounding:
            self.width = max(self.width * SHRINK, 1e-4 * self.best, 1e-9)
        return [*(self.w + s for s in steps), self.w]

    def learn(self, points: list[tuple], family: list[tuple], tol: float) -> None:
        """``points``: (w, sums) of this column's points; ``family``: those of columns that
        differ in C only."""
        before, moved = self.best, None
        for (w, s), own in [(p, True) for p in points] + [(p, False) for p in family]:
            value = s[0] / self.total + self.penalised(w)
            if value < (self.best if own else 0.98 * self.best):
                self.best, self.best_w = value, w
                moved = None if own else (w, s)
        values = [s[1] / self.total + self.penalised(w) for w, s in points]
        i = int(np.argmin(values))
        w, s = moved or points[i]
        self.w, self.rounding = w, (s[1] - s[0]) / self.total
        self.grad = s[2] / self.total + self.penalty * w
        least = tol * max(self.best, LEAST)
        if len(points) == 1:
            self.curve = s[3] / self.total if moved is None else points[0][1][3] / self.total
            if self.moments is None:            # every row is within the width
                self.moments = 2.0 * self.width * self.curve
            # a start from fewer rows may leave nothing to gain
            self.still = int(-self.step(0.0) @ self.grad < least)
            return
        if i < len(DAMPS):
            self.curve = points[self.guess][1][3] / self.total
            self.damp = max(self.damp * (DAMPS[i] or 0.1), 1e-6)
        else:
            self.damp *= 10 * DAMPS[-1]         # the curvature reached too far
        self.guess = min(i, len(DAMPS) - 1)
        gained = max(before - self.best, values[-1] - values[i])
        self.still = self.still + 1 if max(gained, values[i] - self.best) < least else 0
        self.stuck = self.stuck + 1 if gained < 0.01 * least else 0
        self.open = not (self.rounding < 0.5 * least and self.still >= 2 or self.stuck >= 12)


def solve(blocks: Blocks, columns: Sequence[Column], maps: Sequence[FeatureMap] = (FeatureMap(),),
          max_steps: int = MAX_STEPS, tol: float = TOL, scans: list | None = None
          ) -> list[tuple[np.ndarray, float, float]]:
    """(coefficients, intercept, objective) of every column, in the maps' own columns.
    ``scans`` receives the number of open columns of each scan."""
    size = max(m.size(blocks.inputs) for m in maps) + 1
    most = max(1, min(COLUMNS, BYTES // (8 * size * size)))
    out: list[tuple[np.ndarray, float, float]] = []
    for at in range(0, len(columns), most):
        out += _solve(blocks, list(columns[at:at + most]), maps, max_steps, tol, scans)
    return out


def _frames(blocks: Blocks, maps: Sequence[FeatureMap]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shift and scale of every map's columns (random features need none)."""
    n = max(1.0, sum(c.sum() for c in blocks.counts.values()))
    total = sum(blocks.sums.values(), np.zeros((2, blocks.inputs)))
    mean = total[0] / n
    std = np.sqrt(np.maximum(total[1] / n - mean ** 2, 0.0))
    std = np.where(std > 1e-12 * np.maximum(1.0, np.abs(mean)), std, 1.0)
    return [(mean, std) if m.weights is None else (np.zeros(len(m.phase)), np.ones(len(m.phase))) for m in maps]


def _solve(blocks, columns, maps, max_steps, tol, scans) -> list[tuple[np.ndarray, float, float]]:
    frames = _frames(blocks, maps)
    models = []
    for col in columns:
        rows = blocks.class_rows(col.fold)
        weight = np.ones(blocks.classes)
        if col.balanced:
            held = rows > 0
            weight = np.where(held, rows.sum() / np.maximum(rows, 1) / max(1, held.sum()), 0.0)
        shift, scale = frames[col.mapping]
        models.append(_Model(col, len(shift) + 1, float(rows.sum()), weight, scale))
    for part in [*blocks.starts, blocks]:
        for m in models:
            rows = part.class_rows(m.column.fold)
            mine = rows[m.column.positive]
            m.begin(max(float((rows * m.class_weight).sum()), 1e-300),
                    part is not blocks and min(mine, rows.sum() - mine) < START_SIDE)
        _steps(part, models, maps, frames, max_steps, scans, tol)
    out = []
    for m in models:
        shift, scale = frames[m.column.mapping]
        coef = m.best_w[:-1] / scale
        out.append((coef, float(m.best_w[-1] - coef @ shift), m.best))
    return out


def _steps(blocks, models, maps, frames, max_steps, scans, tol) -> None:
    """Newton steps over the rows of one table until all columns are closed."""
    for _ in range(max_steps):
        open_ = [m for m in models if m.open]
        if not open_:
            break
        if scans is not None:
            scans.append(len(open_))
        groups, owners = [], []
        for g in sorted({m.column.mapping for m in open_}):
            mine = [m for m in open_ if m.column.mapping == g]
            points = [(m, w, j) for m in mine for j, w in enumerate(m.aim())]
            groups.append(_Points(
                maps[g], *frames[g], np.array([w for _, w, _ in points]),
                np.array([m.column.positive for m, _, _ in points]), np.array([m.column.fold for m, _, _ in points]),
                np.array([m.width for m, _, _ in points]), np.array([m.class_weight for m, _, _ in points]),
                np.flatnonzero([j == m.guess for m, _, j in points])))
            owners.append(points)
        met: dict[int, list] = {}
        families: dict[tuple, list] = {}
        for points, sums, g in zip(owners, _scan(blocks, groups), groups):
            curved = {int(p): i for i, p in enumerate(g.curved)}
            for i, (m, w, _) in enumerate(points):
                point = (w, (sums[0][i], sums[1][i], sums[2][i], sums[3][curved[i]] if i in curved else None))
                met.setdefault(id(m), []).append(point)
                families.setdefault(m.column.family(), []).append((id(m), point))
        for m in open_:
            m.learn(met[id(m)], [p for who, p in families[m.column.family()] if who != id(m)], tol)


def held_out_counts(blocks: Blocks, models: Sequence[tuple[int, int, int, np.ndarray, np.ndarray]],
                    maps: Sequence[FeatureMap]) -> DataFrame:
    """(model, fold, actual, predicted, n) of class indexes over each model's held-out
    rows, in one scan.  ``models``: (model, fold, mapping, coefficients per class,
    intercepts); with one class row the sign decides between classes 0 and 1."""
    spark = blocks.table.sparkSession
    sent = spark.sparkContext.broadcast(([vars(m) for m in maps], list(models), blocks.classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, each, k = sent.value
        kept = [FeatureMap(**m) for m in held]
        counts = [np.zeros(k * k, np.int64) for _ in each]
        folds: dict[int, dict[int, list]] = {}
        for out, (_, f, g, coef, icept) in zip(counts, each):
            folds.setdefault(f, {}).setdefault(g, []).append((out, coef, icept))
        for x, y, fold, view in _blocks(batches):
            for f, mapped in folds.items():
                mine = np.flatnonzero((fold == f) & ((view == f) | (view == -1)))
                if not len(mine):
                    continue
                xs, ys = x[mine], y[mine] * k
                for g, models_ in mapped.items():
                    z = kept[g].of(xs)
                    for out, coef, icept in models_:
                        margin = z @ coef.T + icept
                        guess = (margin[:, 0] > 0).astype(int) if margin.shape[1] == 1 else margin.argmax(1)
                        out += np.bincount(ys + guess, minlength=k * k)
        rows = [(m, f, c // k, c % k, int(n[c])) for n, (m, f, *_) in zip(counts, each)
                for c in np.flatnonzero(n).tolist()]
        names = ["model", "fold", "actual", "predicted", "n"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=names)

    parts = blocks.table.mapInArrow(run, "model long, fold long, actual long, predicted long, n long")
    return parts.groupBy("model", "fold", "actual", "predicted").agg(F.sum("n").alias("n"))
