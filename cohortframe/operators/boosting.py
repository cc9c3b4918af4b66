"""Second-order boosted trees on byte bins.

Columns are cut once to byte bins (:func:`fit_bins`, one aggregation; :func:`binned`, a stage table), a byte a value.
A small table of bins (up to :data:`APART_BYTES`, and see :func:`apart`) is broadcast and every model trains in a task of its own.
Another stays where it is: a Spark barrier stage, each task with its rows' bins and every model's running margins,
adds up gradient and hessian histograms per (model, node, feature, bin), so a level of all models is one exchange and a round is
no job.  The sums go through files in the shared checkpoint folder, since each ``allGather`` sleeps a second whatever its size;
it is used where that folder is no mounted path.  A stage runs :data:`SEGMENT` rounds and returns one row per tree; the next
stage goes on from the margins that the tasks left in that folder (:class:`Margins`; without them it replays the trees), so a
lost executor costs one segment.
Both ways give the same trees to the bit.

Many models train at once (:class:`Slot`): each sees the rows of its group, holds out one fold, and has its own settings.
Validation losses come out of the same pass; a model that has not improved for ``patience`` rounds
takes no further part, and is cut at its best round without a refit.

Gradients, hessians and losses are whole numbers (fixed point, as many bits as the row count leaves), so
sums do not depend on how rows are dealt to tasks, and a model trained beside others is the one trained alone.

Growth: ``level`` splits every node that gains; ``leaf`` takes the best leaf first up to a number of leaves;
``symmetric`` has one split for all nodes of a level.  NULL is a bin of its own whose side each split learns.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import os
import time
import uuid
import zlib
from collections.abc import Callable, Generator, Iterator
from contextlib import contextmanager, suppress
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortframe.session import cut_lineage, mounted, scratch_path

#: Bins of a column at most (and one for NULL); accuracy of their quantiles.
MAX_BINS, ACCURACY = 128, 10_000
#: Rounds of one barrier stage; rows of a task and tasks of a stage, about.
SEGMENT, TASK_ROWS, MAX_TASKS = 100, 12_000, 64
#: Bytes of a table of bins that is sent to every task (checked), and of a row besides its bins.
APART_BYTES, ROW_BYTES = 64 << 20, 40
#: Rows that a task gets through in the time that the exchanges of a round take, about.
EXCHANGE_ROWS = 200_000
#: Rows of a histogram pass, values of one message of ``allGather``.
CHUNK_ROWS, MESSAGE_VALUES = 1 << 16, 1 << 22
#: Joint bins of the columns that are counted together at most; four times as many from so many rows of a task, and a part of them for many nodes of few rows.
CELLS, WIDE_ROWS, NARROW = 2048, 1 << 20, 8
#: Values that a task reads whole in an exchange by files (beyond, tasks add up a slice each); seconds between looks and until it gives up.
WHOLE_VALUES, LOOK, GIVE_UP = 1 << 21, 0.001, 900.0
#: Rows scored at once: what is made for a tree stays in a core's cache.
SCORED_ROWS = 1 << 15
#: A split has to gain more than this.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """What shapes the trees; shares are of rows and columns, drawn anew for each tree."""

    rounds: int = 500
    rate: float = 0.1
    depth: int = 5
    growth: str = "level"
    leaves: int = 31
    l1: float = 0.0
    l2: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 0.0
    least_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    mean_base: bool = True
    seed: int = 42
    patience: int | None = None


@dataclass(frozen=True)
class Slot:
    """A model to train: rows of ``group`` (and rows of no group); fold ``held`` is for validation only."""

    name: str
    settings: Settings
    held: int | None = None
    group: int | None = None


# ------------------------------------------------------------------ the trained model

@dataclass
class Boosted:
    """Trees as flat arrays; a leaf points to itself, so a row walks all levels of a tree alike."""

    features: list[str]
    base: float
    trees: list[dict] = field(default_factory=list)
    history: list[tuple] = field(default_factory=list)
    settings: Settings = Settings()

    def __post_init__(self):
        self._flat = self._codes = None

    def __getstate__(self):
        return {**self.__dict__, "_flat": None, "_codes": None}

    def flat(self) -> dict:
        if self._flat is None:
            sizes = [len(t["feature"]) for t in self.trees]
            root = np.cumsum([0, *sizes[:-1]]) if sizes else np.empty(0, np.int64)
            cat = lambda k, kind: np.concatenate([np.asarray(t[k], kind) for t in self.trees]) if sizes else np.empty(0, kind)
            feature, shift = cat("feature", np.int64), np.repeat(root, sizes)
            here = np.arange(len(feature))
            leaf = feature < 0
            self._flat = {
                "root": root, "depth": [_depth(t) for t in self.trees], "feature": np.where(leaf, 0, feature), "threshold": cat("threshold", np.float64),
                "missing_left": cat("missing_left", bool), "left": np.where(leaf, here, cat("left", np.int64) + shift),
                "right": np.where(leaf, here, cat("right", np.int64) + shift), "value": cat("value", np.float64)}
        return self._flat

    def codes(self) -> tuple[list[np.ndarray], list[tuple[list, np.ndarray] | None]]:
        """Each feature's thresholds, and each tree as :func:`steps` over their numbers (None: too many leaves to number in a byte)."""
        if self._codes is None:
            bounds: list[set] = [set() for _ in self.features]
            for t in self.trees:
                for f, v in zip(t["feature"], t["threshold"]):
                    if f >= 0:
                        bounds[f].add(float(v))
            cuts = [np.array(sorted(b)) for b in bounds]
            self._codes = cuts, [steps(t, cuts) for t in self.trees]
        return self._codes

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows ``x`` (columns in the order of ``features``, NaN for NULL)."""
        out = np.full(len(x), self.base)
        cuts, trees = self.codes()
        for a in range(0, len(x), SCORED_ROWS):
            part, to = x[a:a + SCORED_ROWS], out[a:a + SCORED_ROWS]
            nulls = [n if n.any() else None for n in np.isnan(part.T)]
            code = [np.searchsorted(c, v).astype(np.uint8 if len(c) < 256 else np.uint16 if len(c) < 1 << 16 else np.int64) if len(c) else None for c, v in zip(cuts, part.T)]
            for i, tree in enumerate(trees):
                to += self._walked(i, part) if tree is None else tree[1].take(leaf_numbers(tree[0], code, nulls, len(part)))
        return out

    def _walked(self, tree: int, x: np.ndarray) -> np.ndarray:
        f, rows, nulls = self.flat(), np.arange(len(x)), np.isnan(x)
        at = np.full(len(x), f["root"][tree])
        for _ in range(f["depth"][tree]):
            column = f["feature"][at]
            left = (x[rows, column] <= f["threshold"][at]) | (nulls[rows, column] & f["missing_left"][at])
            at = np.where(left, f["left"][at], f["right"][at])
        return f["value"][at]

    def cut(self, rounds: int) -> Boosted:
        return replace(self, trees=self.trees[:rounds])


def steps(tree: dict, cuts: list[np.ndarray]) -> tuple[list, np.ndarray] | None:
    """A tree from its leaves up: ``(node, feature, number of its threshold, NULL goes left, children)``, a leaf being its number
    less 256; and the leaves' values.  None if they are more than 256."""
    ids = np.cumsum(np.asarray(tree["feature"]) < 0) - 257
    if ids[-1] >= 0:
        return None
    place = [int(ids[i]) if f < 0 else i for i, f in enumerate(tree["feature"])]
    order, stack = [], [0]
    while stack:
        i = stack.pop()
        if tree["feature"][i] >= 0:
            order.append(i)
            stack += [int(tree["left"][i]), int(tree["right"][i])]
    out = [(i, f := int(tree["feature"][i]), int(np.searchsorted(cuts[f], tree["threshold"][i])), bool(tree["missing_left"][i]),
            place[tree["left"][i]], place[tree["right"][i]]) for i in reversed(order)]
    return out, np.asarray(tree["value"], np.float64)[np.asarray(tree["feature"]) < 0]


def leaf_numbers(order: list, code: list[np.ndarray], nulls: list[np.ndarray | None], n: int) -> np.ndarray:
    """The leaf that each row ends in: a node's rows take its left or its right child's, a byte a row and no look-up."""
    if not order:
        return np.zeros(n, np.uint8)
    found: dict[int, np.ndarray] = {}
    goes: dict[tuple, np.ndarray] = {}
    for node, f, last, missing_left, a, b in order:
        left = goes.get((f, last, missing_left))
        if left is None:
            left = code[f] <= last
            if missing_left and nulls[f] is not None:
                left |= nulls[f]
            left = goes[f, last, missing_left] = np.negative(left.view(np.int8)).view(np.uint8)  # all bits or none
        a, b = (np.uint8(k + 256) if k < 0 else found.pop(k) for k in (a, b))
        out = np.bitwise_and(left, a ^ b)
        found[node] = np.bitwise_xor(out, b, out=out)
    return found[0]


def _depth(tree: dict) -> int:
    level, out = [0], 0
    while True:
        level = [k for i in level if tree["feature"][i] >= 0 for k in (tree["left"][i], tree["right"][i])]
        if not level:
            return out
        out += 1


TREE_SCHEMA = (
    "slot int, round int, base double, train_loss double, val_loss double, tp double, fp double, fn double, feature array<int>, bin array<int>, missing_left array<boolean>, "
    "left array<int>, right array<int>, value array<double>, cover array<double>")


# ------------------------------------------------------------------ bins

def fit_bins(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """Upper bounds of each column's bins but the last, from its quantiles (all values where they are few): one aggregation."""
    shares = [i / max_bins for i in range(1, max_bins)]
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.max(value(c)).alias(f"m{i}") for i, c in enumerate(features)]).first()
    out = []
    for i in range(len(features)):
        out.append(sorted({q for q in (row[f"q{i}"] or []) if q < row[f"m{i}"]}))
    return out


def _bins(columns: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    """Rows x columns of bin numbers: values up to a bin's bound; NULL and NaN are one past the last bin."""
    out = np.empty((len(columns[0]), len(cuts)), np.uint8)
    for i, (v, c) in enumerate(zip(columns, cuts)):
        b = np.searchsorted(np.array(c, np.float64), v, side="left")
        out[:, i] = np.where(np.isnan(v), len(c) + 1, b)
    return out


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)


def binned(df: DataFrame, features: list[str], cuts: list[list[float]], label: str = "label", id_col: str = "id",
           fold_col: str | None = None, group_col: str | None = None) -> DataFrame:
    """``(row, y, fold, grp, bins)``: a hash of the id, the label, the fold and the group (or NULL), a byte per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _bins([_floats(c) for c in b.columns[4:]], cuts)
            size = m.shape[1]
            bins = pa.Array.from_buffers(pa.binary(size), len(m), [None, pa.py_buffer(m.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], bins], ["row", "y", "fold", "grp", "bins"])

    opt = lambda c: F.col(c).cast("int") if c else F.lit(None).cast("int")
    rows = df.select(F.xxhash64(id_col).alias("row"), F.col(label).cast("double").alias("y"), opt(fold_col).alias("fold"), opt(group_col).alias("grp"),
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    return rows.mapInArrow(run, "row long, y double, fold int, grp int, bins binary")


# ------------------------------------------------------------------ growing one tree

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def drawn_rows(row: np.ndarray, share: float, seed: int, rnd: int) -> np.ndarray:
    """Which rows a tree sees; by the row's own hash, wherever it is."""
    out = np.ones(len(row), bool)
    if share >= 1:
        return out
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + rnd * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)
    below = np.uint64(math.ceil(share * (1 << 53)) << 11)  # of the upper 53 bits
    for at in range(0, len(row), CHUNK_ROWS):
        part = slice(at, at + CHUNK_ROWS)
        np.less(_mix(row[part].view(np.uint64) ^ key), below, out=out[part])
    return out


def drawn_columns(n: int, share: float, seed: int, rnd: int) -> np.ndarray:
    if share >= 1:
        return np.arange(n)
    return np.sort(np.random.default_rng([seed, rnd]).permutation(n)[:max(1, int(share * n))])


class Bundle:
    """Narrow columns counted together: each row's joint bin, from whose sums those of the columns follow."""

    def __init__(self, columns: list[int], bins: np.ndarray, sizes: np.ndarray):
        self.columns, self.widths = columns, [int(sizes[c]) + 1 for c in columns]
        self.cells = math.prod(self.widths)
        self.code = bins[columns[0]]
        if len(columns) > 1:
            self.code = self.code.astype(np.uint16)
            for c, width in zip(columns[1:], self.widths[1:]):
                self.code = self.code * np.uint16(width) + bins[c]


def bundled(bins: np.ndarray, sizes: np.ndarray, part: int = 1) -> list[Bundle]:
    """All columns (``bins`` is columns x rows), dealt to bundles of at most ``CELLS`` (or a ``part`` of them) joint bins, or one column; the widest first."""
    most = CELLS // part if part > 1 or bins.shape[1] < WIDE_ROWS else 4 * CELLS
    groups: list[tuple[int, list[int]]] = []
    for c in sorted(range(len(sizes)), key=lambda c: -sizes[c]):
        width = int(sizes[c]) + 1
        fitting = [i for i, (cells, _) in enumerate(groups) if cells * width <= most]
        if fitting:
            cells, columns = groups[fitting[0]]
            groups[fitting[0]] = (cells * width, [*columns, c])
        else:
            groups.append((width, [c]))
    return [Bundle(columns, bins, sizes) for _, columns in groups]


class Layout:
    """Places of the drawn columns' bins in a histogram, side by side, each column's NULL bin last."""

    def __init__(self, columns: np.ndarray, sizes: np.ndarray):
        width = sizes[columns] + 1
        self.columns, self.total = columns, int(width.sum())
        self.start = np.cumsum(width) - width
        self.column = np.repeat(np.arange(len(columns)), width)
        self.bin = np.arange(self.total) - self.start[self.column]
        self.before = self.start[self.column] - 1  # the place before the column
        self.null = (self.start + width - 1)[self.column]
        self.real = self.bin < (width - 1)[self.column]


def soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def gains(hist: np.ndarray, lay: Layout, s: Settings, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain of each ``(node, place, side of NULL)``, right side first; and the nodes' sums.  Splits that may not be are -inf."""
    total = hist[:, :, lay.start[0]:lay.start[0] + int((lay.column == 0).sum())].sum(axis=2)
    run = np.cumsum(hist, axis=2)
    left = run - np.where(lay.before >= 0, run[:, :, lay.before], 0.0)
    left = np.stack([left, left + hist[:, :, lay.null]], axis=-1)
    right = total[:, :, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        def score(x: np.ndarray) -> np.ndarray:
            out = soft(x[:, 0] / unit, s.l1) ** 2 / (x[:, 1] / unit + s.l2)
            return np.where(x[:, 1] > 0, out, 0.0)

        gain = score(left) + score(right) - score(total)[:, None, None]
    ok = np.broadcast_to(lay.real[None, :, None], gain.shape)
    if s.growth != "symmetric":
        ok = ok & (left[:, 1] > 0) & (right[:, 1] > 0) & (left[:, 1] / unit >= s.least_weight) & (right[:, 1] / unit >= s.least_weight)
        if s.least_rows > 1:
            ok = ok & (left[:, 2] >= s.least_rows) & (right[:, 2] >= s.least_rows)
    return np.where(ok, gain, -np.inf), total


def spans(ends: np.ndarray, a: int, b: int) -> tuple[int, np.ndarray]:
    """Of places ``a`` to ``b`` in segments that end at ``ends``: the first segment, and how many are in it and in each further one."""
    first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b)
    return int(first), np.diff(np.minimum(ends[first:last + 1], b), prepend=a)


class Dealt:
    """Rows in the order of the open nodes that they are in; those of nodes that are not split are put aside."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.nodes, self.sizes = rows, np.zeros(1, np.int64), np.array([len(rows)])
        self.aside: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def of(self, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of some open nodes, one after the other, and how many are of each."""
        ends, at = np.cumsum(self.sizes), {n: i for i, n in enumerate(self.nodes.tolist())}
        found = [at[n] for n in nodes]
        return np.concatenate([self.rows[ends[i] - self.sizes[i]:ends[i]] for i in found]), self.sizes[found]

    def split(self, bins: np.ndarray, spot: np.ndarray, shift: np.ndarray, last: np.ndarray, null: np.ndarray, kids: np.ndarray) -> None:
        """Rows go to the children.  ``spot``: each node's place among the split ones, or -1; of these, where the column begins in
        ``bins``, the last bin that goes left, the one more that does (NULL's, or the same), and the children."""
        j = spot[self.nodes]
        if (j < 0).any():
            stays = np.repeat(j < 0, self.sizes)
            self.aside.append((self.nodes[j < 0], self.sizes[j < 0], self.rows.compress(stays)))
            self.rows, self.nodes, self.sizes, j = self.rows.compress(~stays), self.nodes[j >= 0], self.sizes[j >= 0], j[j >= 0]
        lefts, rights, n_left = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(j), np.int64)
        ends, both = np.cumsum(self.sizes), bool((null != last).any())
        for a in range(0, len(self.rows), CHUNK_ROWS):
            rows = self.rows[a:a + CHUNK_ROWS]
            first, sizes = spans(ends, a, a + len(rows))
            mine = j[first:first + len(sizes)]
            each = (lambda v: v[mine[0]]) if len(sizes) == 1 else (lambda v: np.repeat(v[mine], sizes))
            code = bins.take(rows + each(shift))
            left = code <= each(last)
            if both:
                left |= code == each(null)
            if len(sizes) == 1:
                n_left[first] += np.count_nonzero(left)
            else:
                run = np.concatenate([[0], np.cumsum(left)])
                n_left[first:first + len(sizes)] += np.diff(run[np.concatenate([[0], np.cumsum(sizes)])])
            lefts.append(rows.compress(left))
            rights.append(rows.compress(~left))
        self.rows = np.concatenate(lefts + rights)
        self.nodes, self.sizes = kids[j].T.ravel(), np.concatenate([n_left, self.sizes - n_left])

    def put(self, value: np.ndarray, out: np.ndarray) -> None:
        """Each row's node's ``value``."""
        for nodes, sizes, rows in (*self.aside, (self.nodes, self.sizes, self.rows)):
            out[rows] = np.repeat(value[nodes], sizes)


class Grower:
    """One model's rows in one task.  :meth:`round` yields what the task has and receives the sums over all tasks."""

    def __init__(self, slot: Slot, data: dict, sizes: np.ndarray, unit: float, state: dict):
        self.s = slot.settings
        if slot.group not in data["views"]:  # shared by the models of a group
            rows = np.flatnonzero((data["grp"] < 0) | (data["grp"] == (-1 if slot.group is None else slot.group)))
            bins = np.ascontiguousarray(data["bins"][rows].T)  # columns x rows
            data["views"][slot.group] = (bins, bundled(bins, sizes), bundled(bins, sizes, NARROW), *(data[k][rows] for k in ("y", "row", "fold")))
        self.bins, self.bundles, self.narrow, self.y, self.row, fold = data["views"][slot.group]
        val = fold == (-2 if slot.held is None else slot.held)
        self.train, self.held = ~val, np.flatnonzero(val)
        self.sizes, self.unit, self.state = sizes, unit, state
        self.margin, self.p = np.zeros(len(self.y)), None
        self.trees: list[dict] = []
        self.losses: list[tuple] = []
        self.stopped = bool(state.get("stopped"))

    def start(self, margin: np.ndarray | None = None) -> Generator:
        """The base margin, then the trees of earlier stages (or the ``margin`` that they left)."""
        sums = yield np.array([self.y[self.train].sum(), self.train.sum(), len(self.held)])
        self.n_train, self.n_val = sums[1], sums[2]
        mean = min(max(sums[0] / max(1.0, sums[1]), 1e-6), 1 - 1e-6)
        self.base = math.log(mean / (1 - mean)) if self.s.mean_base else 0.0
        self.margin[:] = self.base
        if margin is not None:
            self.margin[:] = margin
            return
        for tree in self.state.get("trees", ()):
            self.margin += tree["value"][self._walk(tree)]

    def _walk(self, tree: dict) -> np.ndarray:
        at = np.zeros(len(self.y), np.int64)
        every = np.arange(len(self.y))
        for _ in range(_depth(tree)):
            f, leaf = tree["feature"][at], tree["feature"][at] < 0
            b = self.bins[np.where(leaf, 0, f), every].astype(np.int64)
            left = np.where(b >= self.sizes[f], tree["missing_left"][at], b <= tree["bin"][at])
            at = np.where(leaf, at, np.where(left, tree["left"][at], tree["right"][at]))
        return at

    def _odds(self) -> np.ndarray:
        """Probabilities of class 1; the losses of a round and the next round read the same ones."""
        if self.p is None:
            self.p = np.empty(len(self.margin))
            for at in range(0, len(self.p), CHUNK_ROWS):  # what is made on the way stays in a core's cache
                p = np.negative(self.margin[at:at + CHUNK_ROWS], out=self.p[at:at + CHUNK_ROWS])
                np.exp(p, out=p)
                p += 1.0
                np.divide(1.0, p, out=p)
        return self.p

    def _loss(self) -> np.ndarray:
        """Losses of the training and the held rows, and how the held rows are told apart at even odds."""
        p, out = self._odds(), np.zeros(2)
        for at in range(0, len(p), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            own = 1 - p[part]
            np.copyto(own, p[part], where=self.y[part] > 0.5)
            np.log(np.maximum(own, 1e-15, out=own), out=own)
            own *= -self.unit / 64
            np.rint(own, out=own)
            first, last = np.searchsorted(self.held, (at, at + CHUNK_ROWS))
            held = own.take(self.held[first:last] - at).sum()
            out += own.sum() - held, held
        yes, y = self.margin.take(self.held) >= 0, self.y.take(self.held) > 0.5
        return np.array([*out, (yes & y).sum(), (yes & ~y).sum(), (~yes & y).sum()])

    def _gradients(self) -> tuple[np.ndarray, np.ndarray]:
        """Of all visible rows."""
        p, g, h = self._odds(), np.empty(len(self.y)), np.empty(len(self.y))
        for at in range(0, len(p), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            a = np.subtract(p[part], self.y[part], out=g[part])
            a *= self.unit
            np.rint(a, out=a)
            b = np.subtract(1, p[part], out=h[part])
            b *= p[part]
            np.maximum(b, 1e-16, out=b)
            b *= self.unit
            np.rint(b, out=b)
            np.maximum(b, 1.0, out=b)
        self.p = None  # many models grow side by side
        return g, h

    def _note(self, sums: np.ndarray, rnd: int) -> None:
        train, val = (float(x) * 64 / self.unit / n if n else math.nan for x, n in zip(sums, (self.n_train, self.n_val)))
        self.losses.append((train, val, *map(float, sums[2:])))
        st = self.state
        if self.n_val and val < st.get("best_loss", math.inf):
            st["best_loss"], st["best_round"] = val, rnd
        if self.s.patience and self.n_val and rnd - st.get("best_round", 0) >= self.s.patience:
            self.stopped = True

    def _histogram(self, lay: Layout, rows: np.ndarray, sizes: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of gradients, hessians and (where the settings ask how many) rows by (node, column's bin); ``rows`` are in the nodes' order, ``sizes`` of each.
        All are whole numbers, so exact in any order."""
        nodes, n = len(sizes), len(rows)
        weights = [g.take(rows), h.take(rows), None][:3 if self.s.least_rows > 1 else 2]
        out = np.zeros((len(weights), nodes, lay.total))
        first = dict(zip(lay.columns.tolist(), lay.start.tolist()))
        node = np.repeat(np.arange(nodes), sizes) if nodes > 1 else None

        def planned(bundles: list[Bundle]) -> tuple[int, list]:
            """About what counting takes, and of each bundle the drawn columns and whether they are counted together: a joint bin takes about as long as a row."""
            plan = [(b, drawn, len(drawn) > 1 and n + nodes * b.cells <= n * len(drawn)) for b in bundles if (drawn := [i for i, c in enumerate(b.columns) if c in first])]
            return sum(n + nodes * b.cells if one else n * len(drawn) for b, drawn, one in plan), plan

        for b, drawn, one in min(planned(self.bundles), planned(self.narrow), key=lambda p: p[0])[1]:
            if one:
                cube = self._sums(b.code, b.cells, rows, weights, node, nodes).reshape(len(weights), nodes, *b.widths)
                for i in drawn:
                    others = tuple(2 + k for k in range(len(b.widths)) if k != i)
                    at = first[b.columns[i]]
                    out[:, :, at:at + b.widths[i]] = cube.sum(axis=others)
            else:
                for i in drawn:
                    at = first[b.columns[i]]
                    out[:, :, at:at + b.widths[i]] = self._sums(self.bins[b.columns[i]], b.widths[i], rows, weights, node, nodes)
        return out.transpose(1, 0, 2)

    @staticmethod
    def _sums(values: np.ndarray, width: int, rows: np.ndarray, weights: list, node: np.ndarray | None, nodes: int) -> np.ndarray:
        """Sums by (weight, node, value).  Rows are in the nodes' order, so a part of them has a few nodes only."""
        out = np.zeros((len(weights), nodes * width))
        for at in range(0, len(rows), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            place = values.take(rows[part]).astype(np.int64)
            first = last = 0
            if node is not None:
                mine = node[part]
                first, last = int(mine[0]), int(mine[-1])
                if first < last:
                    place += (mine - first) * width
            size = (last + 1 - first) * width
            for k, w in enumerate(weights):
                out[k, first * width:first * width + size] += np.bincount(place, None if w is None else w[part], size)
        return out.reshape(len(weights), nodes, width)

    def round(self, rnd: int) -> Generator:
        """Grow tree ``rnd`` (from 1) and move the margins."""
        s, unit = self.s, self.unit
        use = self.train & drawn_rows(self.row, s.row_share, s.seed, rnd)
        seen, rest = Dealt(np.flatnonzero(use)), Dealt(np.flatnonzero(~use))  # by the tree; all others that are visible
        use = None
        g, h = self._gradients()
        lay = Layout(drawn_columns(len(self.sizes), s.column_share, s.seed, rnd), self.sizes)
        tree = {k: [] for k in ("feature", "bin", "missing_left", "left", "right", "gain")}
        sums: list[np.ndarray] = []

        def add(total: np.ndarray) -> int:
            for k, v in (("feature", -1), ("bin", 0), ("missing_left", False), ("left", -1), ("right", -1), ("gain", 0.0)):
                tree[k].append(v)
            sums.append(total)
            return len(sums) - 1

        hist = yield self._histogram(lay, seen.rows, seen.sizes, g, h)
        level = [add(hist[0][:, :int((lay.column == 0).sum())].sum(axis=1))]
        for depth in range(s.depth):
            gain, _ = gains(hist, lay, s, unit)
            if s.growth == "symmetric":
                every = gain.sum(axis=0)
                best = int(np.argmax(every))
                if not every.ravel()[best] > max(LEAST_GAIN, s.least_gain):
                    break
                chosen = np.full(len(level), best)
                split = np.arange(len(level))
            else:
                flat = gain.reshape(len(level), -1)
                chosen = np.argmax(flat, axis=1)
                split = np.flatnonzero(flat[np.arange(len(level)), chosen] > max(LEAST_GAIN, s.least_gain))
            if not len(split):
                break
            place, side = chosen // 2, chosen % 2
            run = np.cumsum(hist, axis=2)
            kids, small, large = [], [], []
            for i in split:
                node, k = level[i], int(place[i])
                tree["feature"][node], tree["bin"][node] = int(lay.columns[lay.column[k]]), int(lay.bin[k])
                tree["missing_left"][node], tree["gain"][node] = bool(side[i]), float(gain[i].reshape(-1)[chosen[i]])
                left = run[i][:, k] - (run[i][:, lay.before[k]] if lay.before[k] >= 0 else 0.0) + (hist[i][:, lay.null[k]] if side[i] else 0.0)
                a, b = add(left), add(sums[node] - left)
                tree["left"][node], tree["right"][node] = a, b
                kids.append((a, b))
                first = sums[a][1] <= sums[b][1]
                small.append(a if first else b)
                large.append(b if first else a)
            spot = np.full(len(sums), -1)
            spot[[level[i] for i in split]] = np.arange(len(split))
            column = np.array([tree["feature"][level[i]] for i in split])
            last = np.array([tree["bin"][level[i]] for i in split], np.uint8)
            null = np.where([tree["missing_left"][level[i]] for i in split], self.sizes[column], last).astype(np.uint8)
            for dealt in (seen, rest):
                dealt.split(self.bins.ravel(), spot, column * len(self.y), last, null, np.array(kids))
            if depth + 1 == s.depth:
                break
            part = yield self._histogram(lay, *seen.of(small), g, h)
            by = dict(zip(small, part))
            by.update(zip(large, hist[split] - part))
            level = [k for pair in kids for k in pair]
            hist = np.stack([by[k] for k in level])
        g = h = None
        yield from self._finish(tree, np.array(sums), (seen, rest), rnd)

    def _finish(self, tree: dict, sums: np.ndarray, dealt: tuple[Dealt, ...], rnd: int) -> Generator:
        s = self.s
        t = {k: np.array(v) for k, v in tree.items()}
        ends_in = np.arange(len(sums))
        if s.growth == "leaf":
            keep, leaf_of = best_first(t, s.leaves)
            t = {k: v[keep] for k, v in t.items()}
            new = np.full(len(sums), -1)
            new[keep] = np.arange(len(keep))
            inner = t["feature"] >= 0
            t["left"], t["right"] = np.where(inner, new[t["left"]], -1), np.where(inner, new[t["right"]], -1)
            ends_in, sums = new[leaf_of], sums[keep]
        weight = sums[:, 1] / self.unit
        with np.errstate(divide="ignore", invalid="ignore"):
            value = -s.rate * soft(sums[:, 0] / self.unit, s.l1) / (weight + s.l2)
        value = np.where(sums[:, 1] > 0, value, 0.0)
        t["value"], t["cover"] = np.where(t["feature"] < 0, value, 0.0), weight
        step = np.empty(len(self.y))
        for d in dealt:
            d.put(t["value"][ends_in], step)
        self.margin += step
        self.p = step = None
        self.trees.append({k: t[k] for k in ("feature", "bin", "missing_left", "left", "right", "value", "cover")})
        self._note((yield self._loss()), rnd)


def best_first(t: dict, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a fully grown tree, the nodes that splitting the best leaf first leaves, and each node's leaf among them.

    A node's best split does not depend on the order of splitting, so growing all levels and then
    taking splits from a queue by gain gives the tree of growing leaf by leaf.
    """
    queue = [(-t["gain"][0], 0)] if t["feature"][0] >= 0 else []
    taken, n = set(), 1
    while queue and n < leaves:
        _, i = heapq.heappop(queue)
        taken.add(i)
        n += 1
        for k in (t["left"][i], t["right"][i]):
            if t["feature"][k] >= 0:
                heapq.heappush(queue, (-t["gain"][k], int(k)))
    leaf_of = np.arange(len(t["feature"]))
    keep = [0]
    for i in range(len(leaf_of)):  # parents come before children
        if t["feature"][i] < 0:
            continue
        for k in (t["left"][i], t["right"][i]):
            if i in taken and leaf_of[i] == i:
                keep.append(int(k))
            else:
                leaf_of[k] = leaf_of[i]
        if i not in taken:
            t["feature"][i] = -1
    return np.array(sorted(keep)), leaf_of


# ------------------------------------------------------------------ the barrier stage

def together(steps: list[Generator], exchange: Callable[[np.ndarray], np.ndarray]) -> None:
    """Run generators side by side: what all of them yield goes through one exchange."""
    asked = []
    for g in steps:
        try:
            asked.append((g, next(g)))
        except StopIteration:
            pass
    while asked:
        total = exchange(np.concatenate([a.ravel() for _, a in asked]))
        more, start = [], 0
        for g, a in asked:
            part = total[start:start + a.size].reshape(a.shape)
            start += a.size
            try:
                more.append((g, g.send(part)))
            except StopIteration:
                pass
        asked = more


def _pack(values: np.ndarray) -> str:
    """Text of an array of whole numbers; only the non-zero ones if these are few."""
    seen = np.flatnonzero(values)
    if len(seen) * 3 < len(values) * 2:
        raw = b"s" + seen.astype(np.int32).tobytes() + values[seen].tobytes()
    else:
        raw = b"d" + values.tobytes()
    return base64.b64encode(raw).decode()


def _add(text: str, out: np.ndarray) -> None:
    raw = base64.b64decode(text)
    if raw[:1] == b"d":
        out += np.frombuffer(raw, np.float64, offset=1)
        return
    n = (len(raw) - 1) // 12
    out[np.frombuffer(raw, np.int32, n, 1)] += np.frombuffer(raw, np.float64, n, 1 + 4 * n)


def _by_messages(context) -> Callable[[np.ndarray], np.ndarray]:
    tasks = len(context.getTaskInfos())
    size = MESSAGE_VALUES // tasks + 1

    def run(local: np.ndarray) -> np.ndarray:
        out = np.zeros(len(local))
        for at in range(0, len(local), size):
            for text in context.allGather(_pack(local[at:at + size])):
                _add(text, out[at:at + size])
        return out

    return run


class ByFiles:
    """Sums over the tasks of a stage through files of a shared folder: each task writes its values and reads the others'.

    Many values are added up in two steps, each task a slice.  A file appears whole (it is renamed), and goes when
    all tasks have written the next one, as they have read it by then.
    """

    def __init__(self, folder: str, me: int, tasks: int, whole: int = WHOLE_VALUES, give_up: float = GIVE_UP):
        self.folder, self.me, self.tasks, self.whole, self.give_up = folder, me, tasks, whole, give_up
        self.step, self.mine = 0, []

    def _path(self, step: int, task: int) -> str:
        return os.path.join(self.folder, f"{step}-{task}")

    def _share(self, values: np.ndarray) -> None:
        self.step += 1
        path = self._path(self.step, self.me)
        with open(f"{path}.part", "wb") as f:
            f.write(np.ascontiguousarray(values, np.float64).data)
        os.replace(f"{path}.part", path)
        self.mine.append(path)

    def _of(self, task: int, first: int, last: int) -> np.ndarray:
        path, until = self._path(self.step, task), time.monotonic() + self.give_up
        while True:
            try:
                with open(path, "rb") as f:
                    f.seek(first * 8)
                    return np.frombuffer(f.read((last - first) * 8), np.float64)
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"no values of task {task} in {self.folder}") from None
                time.sleep(LOOK)

    def _forget(self, keep: int = 1) -> None:
        """Files of earlier steps go: all tasks have come to this one."""
        for path in self.mine[:len(self.mine) - keep]:
            os.remove(path)
        self.mine = self.mine[len(self.mine) - keep:]

    def __call__(self, local: np.ndarray) -> np.ndarray:
        n, tasks = len(local), self.tasks
        self._share(local)
        first, last = (0, n) if n * tasks <= self.whole else (n * self.me // tasks, n * (self.me + 1) // tasks)
        out = np.array(local[first:last], np.float64)
        for k in range(1, tasks):
            out += self._of((self.me + k) % tasks, first, last)
        self._forget()
        if last - first == n:
            return out
        self._share(out)
        parts = [out if k == self.me else self._of(k, 0, n * (k + 1) // tasks - n * k // tasks) for k in range(tasks)]
        self._forget()
        return np.concatenate(parts)


@contextmanager
def _exchange(context, folder: str | None):
    """A function that adds up arrays over the stage's tasks; ``folder`` is one that all of them see, or None."""
    tasks = len(context.getTaskInfos())
    if tasks == 1:
        yield lambda local: local
        return
    if folder is None:
        yield _by_messages(context)
        return
    # of each attempt its own
    folder = os.path.join(folder, context.allGather(uuid.uuid4().hex)[0])
    os.makedirs(folder, exist_ok=True)
    files = ByFiles(folder, context.partitionId(), tasks)
    yield files
    context.barrier()
    files._forget(0)
    context.barrier()
    if not context.partitionId():
        os.rmdir(folder)


class Margins:
    """What a task's rows have come to after a stage, as files of the shared folder: the next stage needs not replay all trees.

    A file's name has the rows' digest, so a task that has other rows, or the same in another order, finds none and replays.
    """

    def __init__(self, folder: str, run: str, task: int, data: dict):
        digest = 0
        for k in ("row", "y", "fold", "grp", "bins"):
            digest = zlib.crc32(np.ascontiguousarray(data[k]).data, digest)
        self.folder, self.name = folder, f"{run}-{task}-{digest:08x}"

    def _path(self, model: int, rnd: int) -> str:
        return os.path.join(self.folder, f"{self.name}-{model}-{rnd}.npy")

    def load(self, model: int, rnd: int) -> np.ndarray | None:
        try:
            return np.load(self._path(model, rnd))
        except FileNotFoundError:
            return None

    def save(self, model: int, rnd: int, margin: np.ndarray) -> None:
        path = self._path(model, rnd)
        part = f"{path}.{uuid.uuid4().hex}.part"
        os.makedirs(self.folder, exist_ok=True)
        with open(part, "wb") as f:
            np.save(f, margin)
        os.replace(part, path)

    def forget(self, model: int, rnd: int) -> None:
        with suppress(FileNotFoundError):
            os.remove(self._path(model, rnd))


def _read(batches: Iterator[pa.RecordBatch], columns: int) -> dict:
    t = list(batches)
    cat = lambda i, kind: np.concatenate([np.empty(0, kind), *(b.column(i).fill_null(-1).to_numpy(zero_copy_only=False).astype(kind) for b in t)])
    bins = [np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(-1, columns) for b in t]
    grp, fold = cat(3, np.int64), cat(2, np.int64)
    return {"row": cat(0, np.int64), "y": cat(1, np.float64), "fold": fold, "grp": grp,
            "bins": np.concatenate([np.empty((0, columns), np.uint8), *bins]), "views": {}}


def rounds(growers: list[Grower], first: int, last: int, exchange: Callable[[np.ndarray], np.ndarray], margins: list | None = None) -> None:
    """Rounds ``first`` to ``last`` (from 1) of all models that have not stopped; ``margins`` are those of earlier rounds, where known."""
    together([g.start(m) for g, m in zip(growers, margins or [None] * len(growers))], exchange)
    for rnd in range(first, last + 1):
        live = [g for g in growers if not g.stopped and rnd <= g.s.rounds]
        if not live:
            return
        together([g.round(rnd) for g in live], exchange)


def _worker(shared, slots: list[Slot], sizes: np.ndarray, unit: float, first: int, last: int, keep_trees: bool, folder: str | None, run_id: str, numbers: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext
        context = BarrierTaskContext.get()
        data = _read(batches, len(sizes))
        growers = [Grower(s, data, sizes, unit, dict(st)) for s, st in zip(slots, shared.value)]
        kept = Margins(folder, run_id, context.partitionId(), data) if folder else None
        known = [kept.load(i, first - 1) for i in numbers] if kept and first > 1 else None
        with _exchange(context, folder) as exchange:
            rounds(growers, first, last, exchange, known)
        for i, g in zip(numbers, growers) if kept else ():
            if not g.stopped and last < g.s.rounds:
                kept.save(i, last, g.margin)
            kept.forget(i, first - 1)
        if not context.partitionId():
            yield from _grown(growers, range(len(growers)), first, keep_trees)

    return run


def _grown(growers: list[Grower], numbers, first: int, keep_trees: bool) -> Iterator[pa.RecordBatch]:
    """A row for each tree of the models."""
    out = []
    for i, g in zip(numbers, growers):
        for k, (tree, (a, b, tp, fp, fn)) in enumerate(zip(g.trees, g.losses)):
            out.append({"slot": i, "round": first + k, "base": g.base, "train_loss": a, "val_loss": b, "tp": tp, "fp": fp, "fn": fn,
                        **{c: v.tolist() if keep_trees else None for c, v in tree.items()}})
    schema = pa.schema([("slot", pa.int32()), ("round", pa.int32()), ("base", pa.float64()), ("train_loss", pa.float64()), ("val_loss", pa.float64()),
                        ("tp", pa.float64()), ("fp", pa.float64()), ("fn", pa.float64()),
                        ("feature", pa.list_(pa.int32())), ("bin", pa.list_(pa.int32())), ("missing_left", pa.list_(pa.bool_())), ("left", pa.list_(pa.int32())),
                        ("right", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())), ("cover", pa.list_(pa.float64()))])
    yield from pa.Table.from_pylist(out, schema=schema).to_batches(max_chunksize=1000)


def _alone(shared, slots: list[Slot], sizes: np.ndarray, unit: float, keep_trees: bool):
    """Whole models, one after the other: the table is there, nothing is exchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                grower = Grower(slots[i], shared.value, sizes, unit, {})
                rounds([grower], 1, slots[i].settings.rounds, lambda local: local)
                yield from _grown([grower], [i], 1, keep_trees)

    return run


def apart(n_rows: int, n_features: int, n_models: int, cores: int) -> bool:
    """Whether models train in tasks of their own: the table is small, and dealing the rows would not save more time than the exchanges take."""
    tasks = barrier_tasks(n_rows, cores)
    saved = n_rows * (-(-n_models // cores)) - n_rows * n_models / tasks
    return n_rows * (n_features + ROW_BYTES) <= APART_BYTES and saved <= EXCHANGE_ROWS


def barrier_tasks(n_rows: int, cores: int) -> int:
    return max(1, min(cores, MAX_TASKS, -(-n_rows // TASK_ROWS)))


def scale_bits(n_rows: int) -> float:
    """Fixed-point unit: sums over all rows stay whole numbers below 2 ** 53."""
    return 2.0 ** max(8, min(40, 52 - max(1, n_rows).bit_length()))


def train(rows: DataFrame, features: list[str], cuts: list[list[float]], slots: list[Slot], tasks: int | None = None,
          segment: int = SEGMENT, keep_trees: bool = True) -> list[Boosted]:
    """One model for each slot over the table of :func:`binned` rows, which is read once a segment.

    A model sees the rows of its group and those without one (rows oversampled for a fold have the group of the
    model that holds it out, and no fold).  NULL labels are not allowed.  A model with ``patience`` ends at its best round.
    ``keep_trees`` off: only the histories are wanted (one segment).  ``tasks`` asks for the barrier stage, whatever the size.
    """
    if not keep_trees and segment < max(s.settings.rounds for s in slots):
        raise ValueError("without trees there is no next segment")
    spark = rows.sparkSession
    rows = cut_lineage(rows)
    n = rows.count()
    if not n or not features:
        raise ValueError("no rows or no features to train on")
    sizes = np.array([len(c) for c in cuts], np.int64) + 1  # bins of values; the next number is NULL
    unit = scale_bits(n)
    states: list[dict] = [{"trees": []} for _ in slots]
    done: list[list] = [[] for _ in slots]
    base = [0.0] * len(slots)

    def take(grown: list, live: list[int]) -> None:
        for r in grown:
            i = live[r["slot"]]
            base[i] = r["base"]
            tree = {k: np.array(r[k] or [], kind) for k, kind in (("feature", np.int64), ("bin", np.int64), ("missing_left", bool), ("left", np.int64), ("right", np.int64), ("value", float), ("cover", float))}
            done[i].append((r["round"], r["train_loss"], r["val_loss"], r["tp"], r["fp"], r["fn"], tree))
        for i in live:
            done[i].sort(key=lambda r: r[0])
            st, s = states[i], slots[i].settings
            st["trees"] = [r[-1] for r in done[i]]
            best, at = math.inf, 0
            for rnd, _, val, *_ in done[i]:
                if val < best:
                    best, at = val, rnd
            st["best_loss"], st["best_round"] = best, at
            st["stopped"] = bool(s.patience and at and done[i][-1][0] - at >= s.patience)

    cores = spark.sparkContext.defaultParallelism
    if tasks is None and apart(n, len(features), len(slots), cores):
        shared = spark.sparkContext.broadcast(_read(rows.toArrow().to_batches(), len(sizes)))  # APART_BYTES at most
        every = spark.range(0, len(slots), 1, len(slots))
        take(every.mapInArrow(_alone(shared, slots, sizes, unit, keep_trees), TREE_SCHEMA).collect(), list(range(len(slots))))
        shared.unpersist()
    else:
        if tasks is None:
            tasks = barrier_tasks(n, cores)
        folder = mounted(scratch_path(spark, "sums"))
        dealt = cut_lineage(rows.repartition(tasks))
        run_id = uuid.uuid4().hex
        first, most = 1, max(s.settings.rounds for s in slots)
        while first <= most:
            live = [i for i, s in enumerate(slots) if not states[i].get("stopped") and s.settings.rounds >= first]
            if not live:
                break
            last = min(most, first + segment - 1)
            shared = spark.sparkContext.broadcast([states[i] for i in live])
            run = _worker(shared, [slots[i] for i in live], sizes, unit, first, last, keep_trees, folder, run_id, live)
            take(dealt.mapInArrow(run, TREE_SCHEMA, barrier=True).collect(), live)
            shared.unpersist()
            first = last + 1
    out = []
    for i, s in enumerate(slots):
        trees = [_with_thresholds(r[-1], cuts) for r in done[i]]
        model = Boosted(list(features), base[i], trees, [r[:-1] for r in done[i]], s.settings)
        best = states[i].get("best_round", 0)
        out.append(model.cut(best) if s.settings.patience and best else model)
    return out


def _with_thresholds(tree: dict, cuts: list[list[float]]) -> dict:
    bound = [cuts[f][b] if f >= 0 and b < len(cuts[f]) else math.inf for f, b in zip(tree["feature"], tree["bin"])]
    return {**tree, "threshold": np.array(bound)}


def fit(df: DataFrame, features: list[str], slots: list[Slot], label: str = "label", id_col: str = "id", fold_col: str | None = None,
        group_col: str | None = None, tasks: int | None = None, max_bins: int = MAX_BINS) -> list[Boosted]:
    """Bins, then models: the whole of training from a prepared frame."""
    cuts = fit_bins(df, features, max_bins)
    return train(binned(df, features, cuts, label, id_col, fold_col, group_col), features, cuts, slots, tasks)


# ------------------------------------------------------------------ scoring

def joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, but for the last one."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(h.num_rows for h in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def with_margins(df: DataFrame, fitted: dict[str, Boosted], keep: list[str]) -> DataFrame:
    """``keep`` and a column of log-odds for each model: trees as arrays, all models in one pass over Arrow batches, no shuffle."""
    features = list(dict.fromkeys(f for m in fitted.values() for f in m.features))
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"frame lacks features the model was trained on: {missing}")
    shared = df.sparkSession.sparkContext.broadcast({n: (m, [features.index(f) for f in m.features]) for n, m in fitted.items()})
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in joined(batches, SCORED_ROWS):
            for at in range(0, whole.num_rows, SCORED_ROWS):
                b = whole.slice(at, SCORED_ROWS)
                x = np.stack([_floats(c) for c in b.columns[n_keep:]], axis=1)
                out = [pa.array(m.margins(x[:, places])) for m, places in shared.value.values()]
                yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *out], names)

    names = [*keep, *fitted]
    schema = T.StructType([*df.select(*keep).schema.fields, *(T.StructField(n, T.DoubleType()) for n in fitted)])
    return df.select(*keep, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]).mapInArrow(run, schema)


# ------------------------------------------------------------------ saving

def save(spark: SparkSession, model: Boosted, path: str) -> None:
    """One row a tree, and a row of what is common to them."""
    rows = [(i, *[v.tolist() for v in (t["feature"], t["bin"], t["missing_left"], t["left"], t["right"], t["value"], t["cover"], t["threshold"])]) for i, t in enumerate(model.trees)]
    spark.createDataFrame(rows, "round int, feature array<int>, bin array<int>, missing_left array<boolean>, left array<int>, right array<int>, value array<double>, "
                                "cover array<double>, threshold array<double>").write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame([(model.features, model.base, json.dumps(asdict(model.settings)))], "features array<string>, base double, settings string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/boosted")


def load(spark: SparkSession, path: str) -> Boosted:
    head = spark.read.parquet(f"{path}/boosted").first()
    kinds = {"feature": np.int64, "bin": np.int64, "missing_left": bool, "left": np.int64, "right": np.int64, "value": float, "cover": float, "threshold": float}
    rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["round"])
    return Boosted(list(head["features"]), head["base"], [{k: np.array(r[k], t) for k, t in kinds.items()} for r in rows], [], Settings(**json.loads(head["settings"])))
