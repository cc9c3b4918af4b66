"""Oversampling and Tomek links (H4-H7).

Exact k nearest neighbours by cells: a bounded sample of rows serves as
pivots, each row belongs to the cell of its nearest pivot, and a cell knows
its radius.  A row's own cell gives an upper bound for the distance of its
k-th neighbour; by the triangle inequality only cells with
``dist(row, pivot) - radius`` below that bound can hold a nearer one, and of these only
cells whose box (least and greatest value of each feature) is that near; the
row is sent to those alone; where most cells are left (many dimensions) cells are packed, so that a row is sent to fewer.  Large cells are dealt to sub-blocks of bounded
size on both sides, so no group outgrows a task.  Inside a block distances come from matrix
products in chunks (never rows x rows x features) and the few best are
computed anew term by term.  Ties are ordered by (distance, neighbour id),
distances counting as equal to nine decimals.

Synthesis is a join plan: ``spark.range(n_synth)`` draws a base rank, a
neighbour slot and an interpolation weight from seeded hashes; joins fetch
the base row, its neighbour id and the neighbour row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortframe.functions.columns import hash_hex, hash_uniform
from cohortframe.operators.rank import seeded_rank
from cohortframe.session import cut_lineage

SENTINEL = -999.0
#: Rows a cell should have, most pivots (they are sent to every task), and most rows of a block.
CELL_ROWS, MAX_PIVOTS, BLOCK_ROWS = 2000, 4096, 8000
#: Rows of one distance matrix, and the decimals to which distances are compared.
CHUNK, DECIMALS = 1024, 9
#: Values of one matrix of a search, groups of columns of which the least values are taken, and near rows whose distance is taken term by term at once.
MATRIX_VALUES, GROUPS, NEAR_ROWS = 1 << 18, 64, 1 << 16
#: Rows whose cells are found at once, and copies of rows sent at once.
ROUTE_ROWS, ROUTED = 256, 1 << 13
#: Rows, about, that are asked how many cells the bounds leave, and the share of cells beyond which cells are packed.
ASKED_ROWS, PACK_SHARE = 1000, 0.3
_NEAR = "id long, nb_id long, dist double"


def _sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """|a|^2 + |b|^2 - 2ab: rows x rows, without a third dimension."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0)


def _nearest(ia: np.ndarray, xa: np.ndarray, ib: np.ndarray, xb: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k nearest of ``b`` for each row of ``a``, exact and with ties by id."""
    out_i, out_n, out_d = [], [], []
    order = np.argsort(ib, kind="stable")
    ib, xb = ib[order], xb[order]
    bb = (xb * xb).sum(axis=1)
    scale = 1e-9 * (1.0 + bb.max(initial=0.0) + (xa * xa).sum(axis=1).max(initial=0.0))
    kk = min(k, len(ib))
    groups = max(kk, min(len(ib), GROUPS))
    width = len(ib) // groups
    step = max(1, min(CHUNK, MATRIX_VALUES // len(ib)))
    for at in range(0, len(ia), step):
        rows = slice(at, at + step)
        d2 = xa[rows] @ xb.T
        d2 *= -2.0
        d2 += bb
        d2 += (xa[rows] * xa[rows]).sum(axis=1)[:, None]
        if exclude_self:
            first, n = np.searchsorted(ib, ia[rows]), np.searchsorted(ib, ia[rows], side="right")
            n -= first
            d2[np.repeat(np.arange(len(n)), n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())] = np.inf
        # the k-th of the groups' least values is no less than the k-th of all
        least = d2[:, :groups * width].reshape(len(d2), groups, width).min(axis=2)
        bound = np.partition(least, kk - 1, axis=1)[:, kk - 1]
        row, near = np.nonzero(d2 <= (bound + scale)[:, None])
        known = np.isfinite(d2[row, near])
        row, near = row[known], near[known]
        dist = np.empty(len(row))
        for k0 in range(0, len(row), NEAR_ROWS):  # many rows may be equally near
            some = slice(k0, k0 + NEAR_ROWS)
            diff = xb[near[some]] - xa[at + row[some]]
            dist[some] = np.round(np.sqrt((diff * diff).sum(axis=1)), DECIMALS)
        best = np.lexsort((near, dist, row))  # ``b`` is in the order of its ids
        row, near, dist = row[best], near[best], dist[best]
        first = np.searchsorted(row, np.arange(len(d2)))
        keep = np.arange(len(row)) - first[row] < kk
        out_i.append(ia[at + row[keep]])
        out_n.append(ib[near[keep]])
        out_d.append(dist[keep])
    empty = [np.empty(0, np.int64)]
    return pd.DataFrame({"id": np.concatenate(out_i or empty), "nb_id": np.concatenate(out_n or empty),
                         "dist": np.concatenate(out_d or [np.empty(0)])})


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.empty((0, width))


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy("dist", "nb_id")
    return found.withColumn("nb_rank", F.row_number().over(w)).filter(F.col("nb_rank") <= k)


class _Blocks:
    """Rows ``(id, x, cell)`` to be searched, dealt to blocks of bounded size; rows that ask are dealt likewise, and each of
    their blocks meets each block of the cell."""

    def __init__(self, right: DataFrame, n_cells: int, counts: dict, d: int, k: int, exclude_self: bool, block_rows: int):
        self.n_cells, self.d, self.k, self.exclude_self, self.block_rows = n_cells, d, k, exclude_self, block_rows
        self.parts = self._parts(counts)
        self.right = right.select("id", "x", "cell", F.pmod(F.xxhash64("id"), self.parts).alias("sub"))

    def _parts(self, counts: dict) -> Column:
        """Blocks of a row's cell, from the rows of each cell (as many as there are pivots at most)."""
        parts = [max(1, -(-counts.get(c, 0) // self.block_rows)) for c in range(self.n_cells)]
        return F.element_at(F.array(*[F.lit(p).cast("long") for p in parts]), F.col("cell").cast("int") + 1) if max(parts) > 1 else F.lit(1).cast("long")

    def search(self, asked: DataFrame) -> DataFrame:
        """``(id, nb_id, dist)``: the nearest in each block of the cell of ``asked(id, x, cell)``."""
        asked = cut_lineage(asked.select("id", "x", "cell"))
        left_parts = self._parts({r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()})
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        a = asked.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), left_parts)).select("*", every(self.parts).alias("sub"))
        b = self.right.select("*", every(left_parts).alias("part"))
        d, k, exclude_self = self.d, self.k, self.exclude_self

        def block(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            if p.empty or q.empty:
                return pd.DataFrame({"id": pd.Series(dtype="int64"), "nb_id": pd.Series(dtype="int64"), "dist": pd.Series(dtype="float64")})
            return _nearest(p["id"].to_numpy(), _matrix(p["x"], d), q["id"].to_numpy(), _matrix(q["x"], d), k, exclude_self)

        keys = ["cell", "sub", "part"]
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(block, _NEAR)


def _vectors(df: DataFrame, features: list[str], id_col: str) -> DataFrame:
    known = lambda f: F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")),
                             F.raise_error(F.lit(f"{f}: NULL or NaN has no distance"))).otherwise(F.col(f).cast("double"))
    return df.select(F.col(id_col).cast("long").alias("id"), F.array(*[known(f) for f in features]).alias("x"))


#: Trees of the projection forest, rows of a leaf, and rows of the sample that its splits are fitted on (more rows than this in a leaf are dealt to blocks).
TREES, LEAF_ROWS, SAMPLE_ROWS = 12, 1500, 50_000


def _fit_tree(x: np.ndarray, leaf_rows: float, rng: np.random.Generator) -> list[tuple]:
    """Splits at the median of a random direction until a leaf stands for few rows: ``(direction, cut, left, right)``, leaves negative."""
    nodes: list = []

    def grow(rows: np.ndarray) -> int:
        if len(rows) <= max(2.0, leaf_rows):
            nodes.append(None)
            return len(nodes) - 1
        a, b = x[rng.choice(rows, 2)]
        way = a - b if (a != b).any() else rng.normal(size=x.shape[1])
        at = x[rows] @ way
        cut = float(np.median(at))
        left = at <= cut
        if left.all() or not left.any():
            nodes.append(None)
            return len(nodes) - 1
        nodes.append(None)
        me = len(nodes) - 1
        nodes[me] = (way, cut, grow(rows[left]), grow(rows[~left]))
        return me

    grow(np.arange(len(x)))
    return nodes


def _leaf_of(nodes: list, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if nodes[node] is None:
            at[rows] = node
            continue
        way, cut, left, right = nodes[node]
        goes = x[rows] @ way <= cut
        todo += [(left, rows[goes]), (right, rows[~goes])]
    return at


def knn_forest(left: DataFrame, right: DataFrame, features: list[str], k: int = 5, id_col: str = "id", exclude_self: bool = True,
               trees: int = TREES, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """Approximate :func:`knn` for many dimensions, where the triangle bound leaves most cells: a row is compared with the
    leaf it falls into in each of several random projection trees, so the work grows with the rows.

    The splits are fitted on a bounded sample, every row is indexed.  :func:`recall` measures what is found.
    """
    d = len(features)
    lt, rt = _vectors(left, features, id_col), _vectors(right, features, id_col)
    n = right.count()
    sample = _matrix(rt.orderBy(hash_hex("id", seed), "id").limit(SAMPLE_ROWS).toPandas()["x"], d)  # at most SAMPLE_ROWS rows
    rng = np.random.default_rng(seed)
    forest = [_fit_tree(sample, leaf_rows * len(sample) / max(1, n), rng) for _ in range(trees)] if len(sample) else [[None]]
    start = np.cumsum([0, *map(len, forest)])

    def place(batches):
        for pdf in batches:
            x = _matrix(pdf["x"], d)
            cells = np.stack([start[t] + _leaf_of(nodes, x) for t, nodes in enumerate(forest)], axis=1)
            yield pdf.assign(cells=list(cells))

    def placed(rows: DataFrame) -> DataFrame:
        return rows.mapInPandas(place, "id long, x array<double>, cells array<long>").select("id", "x", F.explode("cells").alias("cell"))

    rt = cut_lineage(placed(rt))
    counts = {r["cell"]: r["count"] for r in rt.groupBy("cell").count().collect()}  # one row a leaf
    found = _Blocks(rt, int(start[-1]), counts, d, k, exclude_self, block_rows).search(placed(lt))
    return _best(found.distinct(), k).withColumnRenamed("id", id_col)


def recall(found: DataFrame, exact: DataFrame, id_col: str = "id") -> float:
    """Share of the exact neighbours that were found, over the rows of ``exact``."""
    hit = exact.select(id_col, "nb_id").join(found.select(id_col, "nb_id"), [id_col, "nb_id"], "left_semi").count()
    return hit / max(1, exact.count())


def knn(left: DataFrame, right: DataFrame, features: list[str], k: int = 5, id_col: str = "id",
        exclude_self: bool = True, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, nb_id, dist, nb_rank): the k nearest ``right`` rows of every
    ``left`` row by Euclidean distance, exact.  NULL or NaN features raise."""
    d = len(features)
    lt, rt = _vectors(left, features, id_col), _vectors(right, features, id_col)
    n = right.count()
    n_pivots = min(MAX_PIVOTS, max(1, math.ceil(n / cell_rows)))
    pivots = _matrix(rt.orderBy(hash_hex("id", 7), "id").limit(n_pivots).toPandas()["x"], d)  # at most MAX_PIVOTS rows
    pivots = np.unique(pivots, axis=0) if len(pivots) else np.zeros((1, d))

    def place(batches):
        for pdf in batches:
            x = _matrix(pdf["x"], d)
            cell, dist = np.empty(len(x), np.int64), np.empty(len(x))
            for at in range(0, len(x), CHUNK):
                d2 = _sq_distances(x[at:at + CHUNK], pivots)
                cell[at:at + CHUNK] = d2.argmin(axis=1)
                diff = x[at:at + CHUNK] - pivots[cell[at:at + CHUNK]]
                dist[at:at + CHUNK] = np.sqrt((diff * diff).sum(axis=1))
            yield pdf.assign(cell=cell, to_pivot=dist)

    placed = "id long, x array<double>, cell long, to_pivot double"
    rt = cut_lineage(rt.mapInPandas(place, placed))
    lt = lt.mapInPandas(place, placed)
    ends = [F.array(*[f(F.col("x")[i]) for i in range(d)]).alias(n) for n, f in (("low", F.min), ("high", F.max))]
    cells = {r["cell"]: r for r in rt.groupBy("cell").agg(F.max("to_pivot").alias("radius"), F.count(F.lit(1)).alias("n"), *ends).collect()}  # one row a pivot
    radius = np.array([cells[c]["radius"] if c in cells else -np.inf for c in range(len(pivots))])
    low_end, high_end = (np.array([cells[c][n] if c in cells else np.full(d, np.nan) for c in range(len(pivots))]).reshape(-1, d) for n in ("low", "high"))
    search = _Blocks(rt, len(pivots), {c: r["n"] for c, r in cells.items()}, d, k, exclude_self, block_rows).search
    best = lambda found: _best(found, k)

    own = cut_lineage(best(search(lt.select("id", "x", "cell"))))
    if len(cells) > 1:
        bound = own.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("bound"))

        def router(pack: np.ndarray, whole: bool):
            """Copies of rows for the packs (``pack``: of each cell, ascending) that can hold a nearer row; ``whole``: their own too."""
            starts = np.flatnonzero(np.diff(pack, prepend=-1))

            def route(batches):
                for pdf in batches:
                    x, ub = _matrix(pdf["x"], d), pdf["bound"].fillna(np.inf).to_numpy()
                    ids, cell = pdf["id"].to_numpy(), pdf["cell"].to_numpy()
                    for at in range(0, len(x), ROUTE_ROWS):
                        rows = slice(at, at + ROUTE_ROWS)
                        low = np.sqrt(_sq_distances(x[rows], pivots)) - radius[None, :]
                        go = (low <= ub[rows][:, None] + 1e-6) & np.isfinite(radius)[None, :]
                        go[np.arange(len(go)), cell[rows]] = whole
                        i, c = np.nonzero(go)
                        for k0 in range(0, len(i), ROUTED):  # a row may have to go to all cells
                            r, to = i[k0:k0 + ROUTED], c[k0:k0 + ROUTED]
                            gap = np.maximum(np.maximum(low_end[to] - x[r + at], x[r + at] - high_end[to]), 0.0)
                            go[r, to] = np.sqrt((gap * gap).sum(axis=1)) <= ub[r + at] + 1e-6
                        i, c = np.nonzero(np.logical_or.reduceat(go, starts, axis=1))
                        for k0 in range(0, len(i), ROUTED):
                            r = i[k0:k0 + ROUTED] + at
                            yield pd.DataFrame({"id": ids[r], "x": list(x[r]), "cell": c[k0:k0 + ROUTED]})

            return route

        routed = "id long, x array<double>, cell long"
        wide = lt.join(bound, "id", "left").select("id", "x", "cell", "bound")
        every = np.arange(len(pivots))
        size = np.array([cells[c]["n"] if c in cells else 0 for c in every])
        pack = _packs(size, block_rows)
        if pack[-1] < every[-1]:
            some = wide.filter(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(max(1, n // ASKED_ROWS))) == 0)
            asked, sent = some.count(), some.mapInPandas(router(every, False), routed).count()
            if sent > PACK_SHARE * asked * len(cells):  # the bounds leave most cells, so a row is sent once to many
                number = F.element_at(F.array(*[F.lit(int(p)) for p in pack]), F.col("cell").cast("int") + 1).cast("long")
                packed = rt.select("id", "x", number.alias("cell"))
                blocks = _Blocks(packed, int(pack[-1]) + 1, dict(enumerate(np.bincount(pack, size).astype(int).tolist())), d, k, exclude_self, block_rows)
                return best(blocks.search(wide.mapInPandas(router(pack, True), routed))).withColumnRenamed("id", id_col)
        others = search(wide.mapInPandas(router(every, False), routed))
        own = best(own.drop("nb_rank").unionByName(others))
    return own.withColumnRenamed("id", id_col)


def _packs(size: np.ndarray, block_rows: int) -> np.ndarray:
    """Number of each cell's pack: neighbours in number, of ``block_rows`` rows together at most or one cell."""
    pack, rows, out = 0, 0, np.zeros(len(size), np.int64)
    for c, n in enumerate(size):
        if c and rows + n > block_rows:
            pack, rows = pack + 1, 0
        rows += n
        out[c] = pack
    return out


def class_counts(df: DataFrame, label: str = "label") -> dict:
    """H7: rows per class (a small fitted result)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def _draw(id_col: str, seed: int) -> Column:
    """60 hashed bits of the id, as a number."""
    return F.conv(F.substring(hash_hex(id_col, seed), 1, 15), 16, 10).cast("long")


def smote(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id", k: int = 5,
          seed: int = 55, sentinel_nulls: bool = False) -> DataFrame:
    """H4 (and H5 with ``sentinel_nulls``): oversample the minority class
    to the majority count with points on segments between a minority row
    and one of its k nearest minority neighbours.  Adds ``synthetic``
    (0/1); synthetic ids are negative.  Without ``sentinel_nulls`` a NULL
    feature in a minority row raises."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df.withColumn("synthetic", F.lit(0))
    minority = min(counts, key=lambda c: (counts[c], c))
    majority = max(counts, key=lambda c: (counts[c], -c if isinstance(c, (int, float)) else 0))
    n_min, n_maj = counts[minority], counts[majority]
    n_syn = n_maj - n_min
    work = df
    if sentinel_nulls:
        work = df.select([F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)).alias(c) if c in features
                          else F.col(c) for c in df.columns])
    mins = work.filter(F.col(label) == minority).select(id_col, *features)
    out = work.withColumn("synthetic", F.lit(0))
    if n_syn <= 0 or n_min < 2:
        return _restore(out, features) if sentinel_nulls else out
    nn = cut_lineage(knn(mins, mins, features, k, id_col))
    ranked = seeded_rank(mins, id_col, seed, None, n_rows=n_min)
    draws = df.sparkSession.range(n_syn).select(
        F.col("id").alias("_i"), (_draw("id", seed) % n_min + 1).alias("rn"), _draw("id", seed + 1).alias("_slot"),
        hash_uniform("id", seed + 2).alias("_u"))
    # a base draws among the neighbours it has, so no draw is lost
    have = nn.groupBy(F.col(id_col).alias("_base")).agg(F.count(F.lit(1)).alias("_nn"))
    base = ranked.select("rn", F.col(id_col).alias("_base"), *[F.col(f).alias(f"_b_{f}") for f in features]).join(have, "_base")
    draws = draws.join(base, "rn").withColumn("nb_rank", (F.col("_slot") % F.col("_nn") + 1).cast("int"))
    nbrows = mins.select(F.col(id_col).alias("nb_id"), *[F.col(f).alias(f"_n_{f}") for f in features])
    syn = (draws.join(nn.select(F.col(id_col).alias("_base"), "nb_rank", "nb_id"), ["_base", "nb_rank"])
                .join(nbrows, "nb_id"))
    new = syn.select((-(F.col("_i") + 1)).alias(id_col),
                     *[(F.col(f"_b_{f}") + F.col("_u") * (F.col(f"_n_{f}") - F.col(f"_b_{f}"))).alias(f)
                       for f in features],
                     F.lit(minority).cast(df.schema[label].dataType).alias(label),
                     F.lit(1).alias("synthetic"))
    others = [c for c in out.columns if c not in new.columns]
    new = new.select(*new.columns, *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in others])
    res = out.unionByName(new.select(out.columns))
    return _restore(res, features) if sentinel_nulls else res


def _restore(df: DataFrame, features: list[str]) -> DataFrame:
    """H5: values within tolerance of the sentinel become NULL again
    (|x - s| <= atol + rtol * |s|, atol 1.0, rtol 1e-5)."""
    tol = 1.0 + 1e-5 * abs(SENTINEL)
    return df.select([F.when(F.abs(F.col(c) - F.lit(SENTINEL)) <= tol, F.lit(None).cast("double"))
                      .otherwise(F.col(c)).alias(c) if c in features else F.col(c) for c in df.columns])


def tomek_links(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id") -> DataFrame:
    """H6 link step: pairs of opposite class that are each other's nearest
    neighbour; returns (id, nb_id) with id < nb_id."""
    nn = cut_lineage(knn(df, df, features, 1, id_col).select(id_col, "nb_id"))
    lab = df.select(F.col(id_col).alias("_k"), F.col(label).alias("_l"))
    mutual = nn.alias("a").join(nn.alias("b"), (F.col(f"a.{id_col}") == F.col("b.nb_id")) &
                                (F.col("a.nb_id") == F.col(f"b.{id_col}")))
    pairs = mutual.select(F.col(f"a.{id_col}").alias(id_col), F.col("a.nb_id").alias("nb_id"))
    pairs = (pairs.join(lab, F.col(id_col) == F.col("_k")).withColumnRenamed("_l", "_la").drop("_k")
                  .join(lab, F.col("nb_id") == F.col("_k")).withColumnRenamed("_l", "_lb").drop("_k"))
    return pairs.filter((F.col("_la") != F.col("_lb")) & (F.col(id_col) < F.col("nb_id"))).select(id_col, "nb_id")


def smote_tomek(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id",
                k: int = 5, seed: int = 55) -> DataFrame:
    """H6: SMOTE, then both members of every Tomek link removed."""
    return remove_links(smote(df, features, label, id_col, k, seed), features, label, id_col)


def remove_links(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id") -> DataFrame:
    """H6 removal step: the rows that are in no Tomek link."""
    links = tomek_links(df, features, label, id_col)
    drop = links.select(id_col).union(links.select(F.col("nb_id").alias(id_col)))
    return df.join(drop, id_col, "left_anti")
