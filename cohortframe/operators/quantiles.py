"""Exact quantiles by distributed selection.

``percentile`` merges all distinct values of a column in one task.  Here a column with few values has them counted one by one;
for any other a mergeable sketch brackets each wanted rank, one scan counts exactly what lies below and inside every
bracket, and only a small bracket's values are counted; a wide one is bracketed again from a sketch of its inside.
All columns, groups and probabilities go through the same scans.  The driver holds brackets and the
values of small ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points of a sketch and its accuracy; how many points a bracket reaches on each side of its rank.
GRID, ACCURACY, REACH = 500, 5_000, 2
#: Values of a bracket that are counted one by one; groups that fit on the driver.
GATHER, MAX_GROUPS = 5_000, 10_000


@dataclass
class _Wanted:
    """A rank (from 0) of a group's column, and the bracket that its value lies in."""

    group: tuple
    column: int
    rank: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    value: float | None = None


def positions(n: int, p: float) -> tuple[int, int]:
    """Ranks between which a quantile of ``n`` values lies."""
    at = (n - 1) * p
    return math.floor(at), math.ceil(at)


def _bracket(points: list[float], share: float, low: float, high: float) -> tuple[float, float]:
    """Points of a sketch around ``share`` of what it has seen."""
    k = share * GRID
    a, b = math.floor(k) - REACH, math.ceil(k) + REACH
    return (points[a - 1] if a >= 1 else low), (points[b - 1] if b < GRID else high)


_POINTS = "array(" + ", ".join(f"{i / GRID!r}D" for i in range(1, GRID)) + ")"


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[Column, list[float]]], by: list[str] | tuple = (), gather: int = GATHER) -> dict[tuple, dict[str, list[float | None]]]:
    """For each group of ``by`` and each name, the values at its probabilities, interpolated between neighbouring ranks.

    NULL and NaN are left out; a column without values gives None, an empty table no groups (and, without ``by``, one
    group of None).  NULL is a group of its own.
    """
    by = list(by)
    names = list(wanted)
    value = lambda e: F.when(~F.isnan(e.cast("double")), e.cast("double"))
    work = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], *[value(wanted[n][0]).alias(f"v{i}") for i, n in enumerate(names)])
    keys = [f"_g{i}" for i in range(len(by))]

    def grouped(frame: DataFrame, aggs: list[Column]) -> dict[tuple, dict]:
        rows = (frame.groupBy(*keys).agg(*aggs) if keys else frame.agg(*aggs)).take(MAX_GROUPS + 1)
        if len(rows) > MAX_GROUPS:
            raise ValueError(f"more than {MAX_GROUPS} groups")
        return {tuple(r[k] for k in keys): r.asDict() for r in rows}

    first = grouped(work, [x for i in range(len(names)) for x in (F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"a{i}"), F.max(f"v{i}").alias(f"b{i}"),
                                                                   F.approx_count_distinct(f"v{i}").alias(f"d{i}"))])
    items: dict[tuple, _Wanted] = {}
    for g, r in first.items():
        for i, name in enumerate(names):
            n = r[f"n{i}"]
            for p in wanted[name][1] if n else ():
                for rank in positions(n, p):
                    items[g, i, rank] = _Wanted(g, i, rank, r[f"a{i}"], r[f"b{i}"], 0, n, r[f"a{i}"] if r[f"a{i}"] == r[f"b{i}"] else None)
    few = [w for w in items.values() if w.value is None and min(w.inside, 2 * first[w.group][f"d{w.column}"]) <= gather]
    _gather(work, keys, few)
    _narrow(work, keys, [w for w in items.values() if w.value is None])
    while open_ := [w for w in items.values() if w.value is None]:
        _count(work, keys, open_)
        for w in open_:
            r = first[w.group]
            if w.rank < w.below:  # the sketch was off
                w.low, w.high, w.inside = r[f"a{w.column}"], w.low, -1
            elif w.rank >= w.below + w.inside:
                w.low, w.high, w.inside = w.high, r[f"b{w.column}"], -1
            elif w.low == w.high:
                w.value = w.low
        known = [w for w in open_ if w.value is None and w.inside >= 0]
        _gather(work, keys, [w for w in known if w.inside <= gather])
        _narrow(work, keys, [w for w in known if w.inside > gather])
    out = {}
    for g, r in first.items():
        out[g] = {}
        for i, name in enumerate(names):
            n = r[f"n{i}"]
            out[g][name] = [_between(n, p, items, g, i) if n else None for p in wanted[name][1]]
    return out


def _between(n: int, p: float, items: dict, g: tuple, i: int) -> float:
    at, (a, b) = (n - 1) * p, positions(n, p)
    x, y = items[g, i, a].value, items[g, i, b].value
    return x if a == b or x == y else (b - at) * x + (at - a) * y


def _of_group(keys: list[str], g: tuple) -> Column:
    out = F.lit(True)
    for k, v in zip(keys, g):
        out = out & F.col(k).eqNullSafe(F.lit(v))
    return out


#: Groups whose brackets go into one expression; more are taken in turns.
TURN = 50


def _exploded(work: DataFrame, keys: list[str], some: list[_Wanted]):
    """Turns of ``(rows, brackets)``: rows ``(keys, k, low, high, v)``, one for each value up to a bracket's end, and what wants bracket ``(group, k)``."""
    groups = list(dict.fromkeys(w.group for w in some))
    for at in range(0, len(groups), TURN):
        wanted: dict[tuple, list[_Wanted]] = {}
        array = None
        for g in groups[at:at + TURN]:
            places: dict[tuple, int] = {}
            for w in some:
                if w.group == g:
                    wanted.setdefault((g, places.setdefault((w.column, w.low, w.high), len(places))), []).append(w)
            mine = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"), F.col(f"v{c}").alias("v")) for (c, low, high), k in places.items()])
            if not keys:
                array = mine
            else:
                array = F.when(_of_group(keys, g), mine) if array is None else array.when(_of_group(keys, g), mine)
        yield work.select(*keys, F.inline(F.filter(array, lambda x: x["v"] <= x["high"]))), wanted


def _count(work: DataFrame, keys: list[str], some: list[_Wanted]) -> None:
    """Exact numbers of values below and inside the brackets."""
    for rows, wanted in _exploded(work, keys, some):
        for w in (w for ws in wanted.values() for w in ws):
            w.below = w.inside = 0
        for r in rows.groupBy(*keys, "k").agg(F.count_if(F.col("v") < F.col("low")).alias("below"), F.count_if(F.col("v") >= F.col("low")).alias("inside")).collect():
            for w in wanted[tuple(r[k] for k in keys), r["k"]]:
                w.below, w.inside = r["below"], r["inside"]


def _gather(work: DataFrame, keys: list[str], some: list[_Wanted]) -> None:
    """The values of small brackets, with their counts."""
    for rows, wanted in _exploded(work, keys, some):
        found: dict[tuple, list[tuple[float, int]]] = {}
        for r in rows.filter("v >= low").groupBy(*keys, "k", "v").count().collect():
            found.setdefault((tuple(r[k] for k in keys), r["k"]), []).append((r["v"], r["count"]))
        for place, ws in wanted.items():
            values = sorted(found[place])
            for w in ws:
                at = w.below
                for v, n in values:
                    at += n
                    if w.rank < at:
                        w.value = v
                        break


def _narrow(work: DataFrame, keys: list[str], some: list[_Wanted]) -> None:
    """New brackets from a sketch of what is inside; where that does not narrow, one end is tried."""
    for rows, wanted in _exploded(work, keys, some):
        sketch = rows.filter("v >= low").groupBy(*keys, "k").agg(F.percentile_approx("v", F.expr(_POINTS), ACCURACY).alias("q"), F.min("v").alias("a"), F.max("v").alias("b"))
        for r in sketch.collect():
            for w in wanted[tuple(r[k] for k in keys), r["k"]]:
                low, high = _bracket(r["q"], (w.rank - w.below + 0.5) / w.inside, r["a"], r["b"])
                if (low, high) == (w.low, w.high):
                    # a few values with many rows each: the nearer end, or what is beyond the lower one
                    middle = low + (high - low) / 2
                    low, high = (low, middle) if w.rank - w.below < w.inside / 2 and middle < high else (math.nextafter(low, math.inf), high)
                w.low, w.high = low, high


def literals(row: dict[str, list[float | None]]) -> dict[str, Column]:
    """One group's quantiles as array columns."""
    return {n: F.array(*[F.lit(v).cast("double") for v in values]) for n, values in row.items()}


def quantile_frame(df: DataFrame, wanted: dict[str, tuple[Column, list[float]]], by: list[str] | tuple = ()) -> DataFrame:
    """The same as a table: the columns of ``by`` and an array of doubles for each name."""
    got = exact_quantiles(df, wanted, by)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema.fields] if by else []
    return df.sparkSession.createDataFrame([(*g, *(r[n] for n in wanted)) for g, r in got.items()], ", ".join([*kinds, *(f"`{n}` array<double>" for n in wanted)]))
