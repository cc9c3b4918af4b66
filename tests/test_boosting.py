"""Boosted trees against plain recursion, independence of the partitioning, search and attributions."""

import itertools
import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortframe.operators import boosting as B
from cohortframe.operators import search as S
from cohortframe.operators import shapley as A


def sample(n=400, d=5, seed=0, nulls=0.15):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 1)
    x[:, 1] = rng.integers(0, 4, n)
    x[rng.random((n, d)) < nulls] = np.nan
    z = np.nan_to_num(x[:, 0]) + (np.nan_to_num(x[:, 1]) > 1) + 1.5 * np.isnan(x[:, 2]) + rng.normal(size=n) * 0.7
    return x, (z > 0.6).astype(float)


def cuts_of(x):
    return [sorted(set(c[~np.isnan(c)].tolist()))[:-1] for c in x.T]


def grow(x, y, s, rounds=1, held=None, fold=None):
    """Trees of one model in this process, without Spark."""
    cuts = cuts_of(x)
    data = {"row": np.arange(len(y)), "y": y, "fold": np.zeros(len(y), int) if fold is None else fold, "grp": np.full(len(y), -1), "bins": B._bins(list(x.T), cuts), "views": {}}
    g = B.Grower(B.Slot("m", s, held), data, np.array([len(c) + 1 for c in cuts]), B.scale_bits(len(y)), {})
    B.rounds([g], 1, rounds, lambda a: a)
    return B.Boosted([f"f{i}" for i in range(x.shape[1])], g.base, [B._with_thresholds(t, cuts) for t in g.trees], [(i + 1, *r) for i, r in enumerate(g.losses)], s), g


class Plain:
    """Splits and leaf values by trying everything."""

    def __init__(self, x, y, s):
        self.x, self.s = x, s
        base = math.log(y.mean() / (1 - y.mean())) if s.mean_base else 0.0
        p = np.full(len(y), 1 / (1 + math.exp(-base)))
        self.g, self.h = p - y, p * (1 - p)

    def score(self, rows):
        g, h = self.g[rows].sum(), self.h[rows].sum()
        return math.copysign(max(abs(g) - self.s.l1, 0), g) ** 2 / (h + self.s.l2) if len(rows) else 0.0

    def splits(self, rows, checked=True):
        for f in range(self.x.shape[1]):
            v = self.x[:, f]
            bounds = sorted(set(v[~np.isnan(v)].tolist()))
            for t, null_left in itertools.product([*bounds[:-1], math.inf], (False, True)):
                left = (v[rows] <= t) | (np.isnan(v[rows]) & null_left)
                a, b = rows[left], rows[~left]
                s = self.s
                if checked and (not len(a) or not len(b) or min(len(a), len(b)) < s.least_rows or min(self.h[a].sum(), self.h[b].sum()) < s.least_weight):
                    yield -math.inf, f, t, null_left, a, b
                else:
                    yield self.score(a) + self.score(b) - self.score(rows), f, t, null_left, a, b

    def best(self, rows):
        out = None
        for c in self.splits(rows):
            if c[0] > max(B.LEAST_GAIN, self.s.least_gain) and (out is None or c[0] > out[0] + 1e-9):
                out = c
        return out

    def value(self, rows):
        g, h = self.g[rows].sum(), self.h[rows].sum()
        return -self.s.rate * math.copysign(max(abs(g) - self.s.l1, 0), g) / (h + self.s.l2)

    def level(self, rows, depth):
        c = self.best(rows) if depth else None
        return self.value(rows) if c is None else (c[1], c[2], self.level(c[4], depth - 1), self.level(c[5], depth - 1))

    def leafwise(self, rows):
        leaves, splits = [(rows, 0, ())], {}
        while len(leaves) < self.s.leaves:
            found = [(c, k) for k, (r, d, _) in enumerate(leaves) if d < self.s.depth and (c := self.best(r))]
            if not found:
                break
            c, k = max(found, key=lambda f: f[0][0])
            r, d, path = leaves.pop(k)
            splits[path] = c[1], c[2]
            leaves += [(c[4], d + 1, path + (0,)), (c[5], d + 1, path + (1,))]
        values = {path: self.value(r) for r, _, path in leaves}
        build = lambda p: (*splits[p], build(p + (0,)), build(p + (1,))) if p in splits else values[p]
        return build(())

    def symmetric(self, rows):
        level, chosen = [rows], []
        for _ in range(self.s.depth):
            every = [list(self.splits(r, False)) for r in level]
            totals = [sum(e[k][0] for e in every) for k in range(len(every[0]))]
            k = max(range(len(totals)), key=lambda i: (round(totals[i], 9), -i))
            if totals[k] <= max(B.LEAST_GAIN, self.s.least_gain):
                break
            chosen.append(every[0][k][1:3])
            level = [part for e in every for part in e[k][4:]]
        values = [self.value(r) if len(r) else 0.0 for r in level]
        build = lambda d, lo, n: values[lo] if d == len(chosen) else (*chosen[d], build(d + 1, lo, n // 2), build(d + 1, lo + n // 2, n // 2))
        return build(0, 0, len(values))


def nested(t, i=0):
    return float(t["value"][i]) if t["feature"][i] < 0 else (int(t["feature"][i]), float(t["threshold"][i]), nested(t, t["left"][i]), nested(t, t["right"][i]))


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return isinstance(a, float) and isinstance(b, float) and abs(a - b) < 1e-6
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("s", [
    B.Settings(depth=4, l2=0.1, least_weight=1.0), B.Settings(depth=3, l1=2.0, l2=1.5, least_gain=0.8), B.Settings(depth=5, least_rows=25),
    B.Settings(growth="leaf", depth=5, leaves=7, least_rows=20), B.Settings(growth="leaf", depth=4, leaves=31, least_gain=0.5, least_rows=5),
    B.Settings(growth="symmetric", depth=3, l2=1.25, mean_base=False), B.Settings(growth="symmetric", depth=4, l2=3.0, least_gain=2.0)])
def test_first_tree_is_that_of_trying_everything(s):
    for seed in range(3):
        x, y = sample(300, seed=seed)
        model, _ = grow(x, y, s)
        plain = Plain(x, y, s)
        rows = np.arange(len(y))
        want = plain.level(rows, s.depth) if s.growth == "level" else plain.leafwise(rows) if s.growth == "leaf" else plain.symmetric(rows)
        assert same(nested(model.trees[0]), want)
        if s.growth == "leaf":
            assert (model.trees[0]["feature"] < 0).sum() <= s.leaves


def test_losses_are_those_of_scoring_again_and_margins_follow_the_trees():
    x, y = sample(500, seed=4)
    fold = np.arange(500) % 4
    for growth in ("level", "leaf", "symmetric"):
        model, g = grow(x, y, B.Settings(rounds=12, growth=growth, leaves=9, row_share=0.7, column_share=0.6), 12, 1, fold)
        for rnd in (1, 5, 12):
            p = 1 / (1 + np.exp(-model.cut(rnd).margins(x)))
            loss = -np.log(np.where(y > 0.5, p, 1 - p))
            assert model.history[rnd - 1][1] == pytest.approx(loss[fold != 1].mean(), abs=1e-6)
            assert model.history[rnd - 1][2] == pytest.approx(loss[fold == 1].mean(), abs=1e-6)
        assert np.allclose(model.margins(x), g.margin)
        yes = model.margins(x)[fold == 1] >= 0
        assert model.history[-1][3:] == ((yes & (y[fold == 1] > 0.5)).sum(), (yes & (y[fold == 1] < 0.5)).sum(), (~yes & (y[fold == 1] > 0.5)).sum())


def test_patience_stops_and_keeps_the_best_round():
    x, y = sample(300, seed=5)
    fold = np.arange(300) % 2
    s = B.Settings(rounds=300, rate=0.5, patience=8)
    _, g = grow(x, y, s, 300, 1, fold)
    val = [r[1] for r in g.losses]
    best = int(np.argmin(val)) + 1
    assert g.state["best_round"] == best and len(val) == best + 8 < 300


@pytest.fixture(scope="module")
def frame(spark):
    x, y = sample(700, seed=6)
    rows = [(i, int(v), i % 3, *[None if math.isnan(c) else float(c) for c in r]) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, label int, fold int, f0 double, f1 double, f2 double, f3 double, f4 double").cache()


FEATURES = [f"f{i}" for i in range(5)]


def trees(model):
    return [{k: v.tolist() for k, v in t.items()} for t in model.trees]


def test_training_does_not_depend_on_tasks_segments_or_company(frame):
    a, b, c = (B.Settings(rounds=5, depth=3, growth=g, leaves=6, row_share=0.8, column_share=0.8) for g in ("level", "leaf", "symmetric"))
    cuts = B.fit_bins(frame, FEATURES)
    table = B.binned(frame, FEATURES, cuts, fold_col="fold")
    alone = B.train(table, FEATURES, cuts, [B.Slot("b", b, 2)], tasks=1)[0]
    beside = B.train(table.repartition(5), FEATURES, cuts, [B.Slot("a", a, 0), B.Slot("b", b, 2), B.Slot("c", c, 1)], tasks=3, segment=4)
    assert trees(alone) == trees(beside[1]) and alone.history == beside[1].history and alone.base == beside[1].base
    again = B.train(table, FEATURES, cuts, [B.Slot("c", c, 1), B.Slot("a", replace(a, rounds=3), 0)])
    assert trees(again[0]) == trees(beside[2]) and trees(again[1]) == trees(beside[0])[:3]
    judged = B.train(table, FEATURES, cuts, [B.Slot("c", c, 1)], segment=5, keep_trees=False)
    assert judged[0].history == beside[2].history


def test_groups_see_their_rows_only(frame):
    s = B.Settings(rounds=2, depth=2)
    cuts = B.fit_bins(frame, FEATURES)
    split = frame.withColumn("g", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.lit(1)))
    both = B.train(B.binned(split, FEATURES, cuts, fold_col="fold", group_col="g"), FEATURES, cuts, [B.Slot("e", s, 1, 0), B.Slot("o", s, 1, 1)], tasks=2)
    for k in (0, 1):
        alone = B.train(B.binned(split.filter(F.col("g") == k), FEATURES, cuts, fold_col="fold"), FEATURES, cuts, [B.Slot("x", s, 1)], tasks=1)[0]
        assert [t["feature"].tolist() for t in alone.trees] == [t["feature"].tolist() for t in both[k].trees]


def test_saved_models_score_the_same(spark, frame, tmp_path):
    from cohortframe.operators import models
    fitted = models.fit_boosted(frame, FEATURES, {k: replace(models.BOOSTED[k], rounds=5) for k in ("gbt_a", "gbt_b")})
    models.save_models(fitted, str(tmp_path))
    back = models.load_models(spark, str(tmp_path))
    assert set(back) == {"gbt_a", "gbt_b"} and back["gbt_a"].settings == fitted["gbt_a"].settings
    for k, m in fitted.items():
        a, b = ({r[0]: r[1:] for r in models.score(x, frame, keep=["id"]).collect()} for x in (m, back[k]))
        assert a == b
    with pytest.raises(ValueError):
        models.score(fitted["gbt_a"], frame.drop("f3"))


def test_made_rows_stay_in_the_folds_of_their_parents(spark, frame):
    from cohortframe.operators import models
    from cohortframe.operators.resample import smote
    # f0 tells the fold, and a made row lies between its parents
    marked = frame.select("id", "label", "fold", (F.col("fold") * 100.0).alias("f0"), F.coalesce("f3", F.lit(0.0)).alias("f1"))
    rows = models.fold_rows(marked, ["f0", "f1"], n_folds=3, oversample=lambda part: smote(part, ["f0", "f1"], "label", "id"))
    made = rows.filter("_group is not null")
    assert made.filter("_fold is not null").isEmpty() and made.select("_group").distinct().count() == 3
    assert made.filter("_group = 0 and f0 < 100").isEmpty() and made.filter("_group = 2 and f0 > 100").isEmpty()


def test_models_learn(spark, frame):
    from cohortframe.operators import models
    from cohortframe.operators.evaluate import auc
    filled = frame.fillna(0.0)
    scores = models.cross_validate(filled, FEATURES, "gbt_b", n_folds=3, rounds=15)
    assert len(scores) == 3 and min(scores) > 0.6
    mean, std, lo, hi = models.mean_and_range([0.5, 0.7])
    assert (round(mean, 9), round(std, 9), round(lo, 9), round(hi, 9)) == (0.6, 0.1, 0.4, 0.8)
    forest = models.fit_model(filled, FEATURES, "forest", numTrees=20)
    got = auc(models.score(forest, filled, keep=["id", "label"]).withColumn("m", F.lit("f")), ["m"]).first()["auc"]
    assert got > 0.8
    # the gradient of the regularised logistic loss is near zero
    n = filled.count()
    logistic = models.fit_model(filled, FEATURES, "logistic")
    w = logistic.stages[-1].coefficients.toArray()
    r = models.score(logistic, filled, keep=["label", *FEATURES]).agg(*[F.sum((F.col("score") - F.col("label")) * F.col(f)) for f in FEATURES]).first()
    assert all(abs(g + c) / n < 1e-3 for g, c in zip(r, w))


def test_rates_and_best_round(spark, frame):
    from cohortframe.operators import models
    train, val = frame.filter("fold <> 0"), frame.filter("fold = 0")
    r = models.rate_results(train, val, FEATURES, rates=[0.1, 0.5], patience=3, max_rounds=40).collect()
    alone, hist, best = models.train_early_stop(train, val, FEATURES, "gbt_a", patience=3, rounds=40, rate=0.5)
    assert {x["rate"]: x["rounds"] for x in r}[0.5] == best == len(alone.trees) and len(hist) == min(40, best + 3)


# ------------------------------------------------------------------ search

def test_proposals_stay_in_range_and_beat_random_draws():
    space = {"a": ("float", 0.0, 1.0), "b": ("log", 0.01, 1.0), "c": ("int", 1, 50)}
    value = lambda d: -(d["a"] - 0.8) ** 2 - (math.log10(d["b"]) + 1.5) ** 2 / 4 - ((d["c"] - 10) / 50) ** 2
    wins = 0
    for seed in range(10):
        found = S.search(space, lambda batch: [(value(d), None) for d in batch], 50, seed)
        assert len(found) == 50 and all(lo <= d[k] <= hi for d, _, _ in found for k, (_, lo, hi) in space.items()) and all(isinstance(d["c"], int) for d, _, _ in found)
        rng = random.Random(1000 + seed)
        wins += max(s for _, s, _ in found) > max(value(S.draw_random(space, rng)) for _ in range(50))
    assert wins >= 8


def test_all_ranges_are_searched_and_failures_are_kept_apart():
    from cohortframe.operators.models import BOOSTED
    for kind, space in S.SEARCH_SPACE.items():
        rng = random.Random(1)
        for _ in range(30):
            replace(BOOSTED[kind], **S.draw_random(space, rng))
    assert S.TRIALS == 50 and [len(S.SEARCH_SPACE[k]) for k in ("gbt_a", "gbt_b", "gbt_c")] == [9, 10, 4]
    found = S.search({"a": ("int", 1, 5)}, lambda batch: [(1.0, "lost") if i % 2 else (0.7, None) for i, _ in enumerate(batch)], 6, startup=2, batch=3)
    assert [s for _, s, _ in found] == [0.7, 0.0, 0.7] * 2
    with pytest.raises(RuntimeError):
        S.search({"a": ("int", 1, 5)}, lambda batch: [(0.0, "lost") for _ in batch], 4)


# ------------------------------------------------------------------ attributions

def enumerated(model, x):
    """Shapley values by summing over all subsets; absent features follow both sides by their training weight."""
    d = x.shape[1]

    def value(t, row, known, i=0):
        f = t["feature"][i]
        if f < 0:
            return t["value"][i]
        a, b = t["left"][i], t["right"][i]
        if f in known:
            left = t["missing_left"][i] if math.isnan(row[f]) else row[f] <= t["threshold"][i]
            return value(t, row, known, a if left else b)
        ca, cb = t["cover"][a], t["cover"][b]
        share = ca / (ca + cb) if ca + cb else 0.5
        return share * value(t, row, known, a) + (1 - share) * value(t, row, known, b)

    out = np.zeros(x.shape)
    for r, row in enumerate(x):
        v = {frozenset(s): sum(value(t, row, set(s)) for t in model.trees) for k in range(d + 1) for s in itertools.combinations(range(d), k)}
        for s, whole in v.items():
            for f in set(range(d)) - s:
                out[r, f] += math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (v[s | {f}] - whole)
    return out


def test_tree_attributions_equal_the_sum_over_subsets(spark, frame):
    x, y = sample(300, seed=9)
    for growth in ("level", "leaf", "symmetric"):
        model, _ = grow(x, y, B.Settings(rounds=4, growth=growth, depth=4, leaves=8, l2=1.0), 4)
        paths, expected = A.leaves(model)
        phi = A.attribute(A.with_tables(paths), x[:12])
        assert np.allclose(phi, enumerated(model, x[:12]))
        assert np.allclose(phi.sum(axis=1) + expected, model.margins(x[:12]))
    rows = A.tree_attributions({"m": model}, frame.filter("id < 5"), keep=("fold",)).collect()
    assert len(rows) == 25 and rows[0].asDict().keys() == {"id", "fold", "model", "feature", "phi"}
    assert A.tree_attributions({"m": model}, frame.limit(0)).collect() == []


def test_kernel_attributions_of_a_linear_margin(spark):
    d = 5
    w = [0.5, -2.0, 0.0, 3.0, 1.0]
    features = [f"f{i}" for i in range(d)]
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, *map(float, rng.normal(size=d))) for i in range(4)], ["id", *features])
    back = spark.createDataFrame([(float(k + 1), *map(float, rng.normal(size=d))) for k in range(3)], ["weight", *features])
    margin = lambda df, keep: df.select(*keep, sum((F.col(f) * c for f, c in zip(features, w)), F.lit(0.7)).alias("margin"))
    b = back.collect()
    mean = {f: sum(r["weight"] * r[f] for r in b) / sum(r["weight"] for r in b) for f in features}
    for n in (None, 16):
        got = {(r["id"], r["feature"]): r["phi"] for r in A.kernel_attributions(margin, rows, features, back, n_coalitions=n).collect()}
        for r in rows.collect():
            for f, c in zip(features, w):
                assert got[r["id"], f] == pytest.approx(c * (r[f] - mean[f]), abs=1e-6)


def test_kernel_error_against_enumeration():
    d, rng = 10, np.random.default_rng(8)
    pairs = rng.normal(size=(d, d))
    value = lambda z: z @ pairs[0] + ((z @ pairs) * z).sum(axis=1) + np.prod(z[:, :3], axis=1)
    every = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    v = value(every.astype(float))
    exact = np.zeros(d)
    for s in range(1 << d):
        k = bin(s).count("1")
        for f in range(d):
            if not s >> f & 1:
                exact[f] += math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) * (v[s | 1 << f] - v[s])
    errors = []
    for n in (60, 250, 1100):
        z, w = A.coalitions(d, n)
        a, b = A.fit_matrix(z, w)
        phi = a @ (value(z.astype(float)) - v[0]) + b * (v[-1] - v[0])
        assert phi.sum() == pytest.approx(v[-1] - v[0])
        errors.append(np.abs(phi - exact).max() / np.abs(exact).max())
    assert errors[-1] < 1e-9 and errors[1] < 0.1


# ------------------------------------------------------------------ sums over tasks

@pytest.mark.parametrize("whole", [1 << 20, 0])
def test_sums_by_files_are_exact_and_leave_none_behind(tmp_path, whole):
    from concurrent.futures import ThreadPoolExecutor
    tasks, steps = 4, 6
    parts = np.random.default_rng(3).integers(-1 << 40, 1 << 40, (steps, tasks, 1001)).astype(float)

    def one(me):
        add = B.ByFiles(str(tmp_path), me, tasks, whole, give_up=60)
        return add, [add(parts[i, me]) for i in range(steps)]

    with ThreadPoolExecutor(tasks) as pool:
        done = list(pool.map(one, range(tasks)))
    for _, sums in done:
        assert all(np.array_equal(s, parts[i].sum(axis=0)) for i, s in enumerate(sums))
    assert len(list(tmp_path.iterdir())) <= 2 * tasks
    for add, _ in done:
        add._forget(0)
    assert not list(tmp_path.iterdir())
    with pytest.raises(TimeoutError):
        B.ByFiles(str(tmp_path), 0, 2, give_up=0.05)(parts[0, 0])


def test_a_stage_goes_on_from_the_margins_of_the_one_before(monkeypatch, tmp_path, frame):
    import os
    from cohortframe.session import mounted, scratch_path
    x, y = sample()
    s = B.Settings(rounds=6, depth=3, row_share=0.8, column_share=0.8)
    whole, _ = grow(x, y, s, 6)
    cuts = cuts_of(x)
    data = {"row": np.arange(len(y)), "y": y, "fold": np.zeros(len(y), int), "grp": np.full(len(y), -1), "bins": B._bins(list(x.T), cuts), "views": {}}
    make = lambda state: B.Grower(B.Slot("m", s), data, np.array([len(c) + 1 for c in cuts]), B.scale_bits(len(y)), state)
    first = make({})
    B.rounds([first], 1, 4, lambda a: a)
    kept = B.Margins(str(tmp_path / "new"), "r", 0, data)
    kept.save(0, 4, first.margin)
    monkeypatch.setattr(B.Grower, "_walk", lambda *a: pytest.fail("replayed"))
    second = make({"trees": first.trees})
    B.rounds([second], 5, 6, lambda a: a, [kept.load(0, 4)])
    assert [t["value"].tolist() for t in first.trees + second.trees] == [t["value"].tolist() for t in whole.trees]
    other = B.Margins(kept.folder, "r", 0, {**data, "row": data["row"][::-1]})
    assert other.load(0, 4) is None and kept.load(1, 4) is None and kept.load(0, 3) is None
    kept.forget(0, 4)
    kept.forget(0, 4)
    assert not os.listdir(kept.folder)
    cuts = B.fit_bins(frame, FEATURES)
    table = B.binned(frame, FEATURES, cuts, fold_col="fold")
    slots = [B.Slot("a", B.Settings(rounds=9, depth=2), 0), B.Slot("p", B.Settings(rounds=60, depth=2, rate=0.5, patience=2), 1)]
    parts, once = (B.train(table, FEATURES, cuts, slots, tasks=3, segment=n) for n in (2, 60))
    assert [(trees(m), m.history, m.base) for m in parts] == [(trees(m), m.history, m.base) for m in once]
    assert not os.listdir(mounted(scratch_path(frame.sparkSession, "sums")))


def test_an_exchange_takes_no_second(frame):
    import os
    import time
    from cohortframe.session import mounted, scratch_path
    table = B.binned(frame, FEATURES, cuts := B.fit_bins(frame, FEATURES), fold_col="fold")
    at = time.monotonic()
    m = B.train(table, FEATURES, cuts, [B.Slot("a", B.Settings(rounds=30, depth=3), 0)], tasks=3)[0]
    assert time.monotonic() - at < 60  # 121 exchanges
    assert len(m.trees) == 30 and not os.listdir(mounted(scratch_path(frame.sparkSession, "sums")))


def test_small_tables_train_apart_unless_dealing_them_saves_more():
    assert B.apart(10_000, 33, 3, 12) and B.apart(500_000, 33, 24, 12)
    assert not B.apart(500_000, 33, 3, 12) and not B.apart(5_000_000, 33, 24, 12)


def test_only_paths_that_tasks_can_open_are_shared_as_files():
    from cohortframe.session import mounted
    assert mounted("/a/b c") == mounted("file:/a/b%20c") == mounted("file:///a/b%20c") == "/a/b c"
    assert mounted("hdfs://n/a") is None and mounted("s3a://b/a") is None


@pytest.mark.parametrize("growth", ["level", "leaf", "symmetric"])
@pytest.mark.parametrize("least_rows", [1, 5])
def test_narrow_columns_are_counted_together(monkeypatch, growth, least_rows):
    x, y = sample(n=20_000, d=4, seed=7)
    x = np.hstack([x, np.random.default_rng(8).integers(0, 4, (20_000, 12)).astype(float)])
    x[::7, 5] = np.nan
    s = B.Settings(rounds=4, depth=5, growth=growth, least_rows=least_rows, column_share=0.7, row_share=0.8)
    calls, counted = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a: calls.append(1) or counted(*a))
    fast, g = grow(x, y, s, rounds=4)
    together = len(calls)
    assert len(g.bundles) < 9 and sorted(c for b in g.bundles for c in b.columns) == list(range(16))
    calls.clear()
    monkeypatch.setattr(B, "CELLS", 1)
    plain, _ = grow(x, y, s, rounds=4)
    assert together < len(calls) * 0.8
    assert fast.history == plain.history
    for a, b in zip(fast.trees, plain.trees):
        assert all(np.array_equal(a[k], b[k]) for k in a)


def test_rows_are_dealt_to_nodes_in_parts(monkeypatch):
    """A level at a time in parts of 64 rows that begin and end inside nodes; NULL's side, rows put aside, and sums by node."""
    monkeypatch.setattr(B, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(11)
    n, sizes = 1000, np.array([6, 3, 9])
    bins = np.ascontiguousarray(np.stack([rng.integers(0, s + 1, n) for s in sizes]).astype(np.uint8))
    rows = np.flatnonzero(rng.random(n) < 0.7)
    dealt, at = B.Dealt(rows), np.zeros(n, int)
    split = {0: (0, 2, True, 1, 2), 1: (2, 4, False, 3, 4), 2: (1, 1, True, 5, 6), 3: (0, 0, False, 7, 8), 6: (2, 7, True, 9, 10)}  # node: column, bin, NULL goes left, children
    for level in ([0], [1, 2], [3, 6]):
        spot = np.full(11, -1)
        spot[level] = np.arange(len(level))
        column, last = (np.array([split[i][k] for i in level]) for k in (0, 1))
        null = np.where([split[i][2] for i in level], sizes[column], last)
        dealt.split(bins.ravel(), spot, column * n, last.astype(np.uint8), null.astype(np.uint8), np.array([split[i][3:] for i in level]))
        for r in range(n):
            if at[r] in level:
                c, b, null_left, left, right = split[at[r]]
                at[r] = left if bins[c, r] <= b or bins[c, r] == sizes[c] and null_left else right
    got = np.full(n, -1.0)
    dealt.put(np.arange(11.0), got)
    assert np.array_equal(got[rows], at[rows]) and (np.delete(got, rows) == -1).all()
    assert sum(len(r) for *_, r in dealt.aside) + len(dealt.rows) == len(rows)
    found, count = dealt.of([8, 9, 7])
    assert count.tolist() == [(at[rows] == k).sum() for k in (8, 9, 7)] and at[found].tolist() == np.repeat([8, 9, 7], count).tolist()
    w = rng.integers(0, 99, n).astype(float)
    sums = B.Grower._sums(bins[2], 10, found, [w[found], None], np.repeat(np.arange(3), count), 3)
    for i, k in enumerate((8, 9, 7)):
        mine = rows[at[rows] == k]
        assert np.array_equal(sums[0, i], np.bincount(bins[2, mine], w[mine], 10)) and np.array_equal(sums[1, i], np.bincount(bins[2, mine], None, 10))


def test_more_columns_are_counted_together_in_tasks_of_many_rows(monkeypatch):
    bins, sizes = np.zeros((4, 50), np.uint8), np.array([40, 40, 40, 40])
    assert len(B.bundled(bins, sizes)) == 2
    monkeypatch.setattr(B, "WIDE_ROWS", 50)
    monkeypatch.setattr(B, "CELLS", 1 << 10)
    assert len(B.bundled(bins, sizes)) == 2 and len(B.bundled(bins[:, :49], sizes)) == 4


def test_scoring_by_selects_equals_walking(monkeypatch):
    x, y = sample(3000, seed=12)
    x[:40, 0] = np.inf
    for s in (B.Settings(rounds=3, depth=1), B.Settings(rounds=5, depth=4, growth="symmetric"), B.Settings(rounds=4, depth=12, l2=0.1), B.Settings(rounds=2, least_gain=1e9)):
        model, g = grow(x, y, s, s.rounds)
        bytes_do = [t is not None for t in model.codes()[1]]
        assert all(bytes_do) == (s.depth < 12)
        want = np.full(len(x), model.base)
        for i in range(len(model.trees)):
            want += model._walked(i, x)
        monkeypatch.setattr(B, "SCORED_ROWS", 700)
        assert np.array_equal(model.margins(x), want) and np.array_equal(want, g.margin)
        assert len(model.margins(x[:0])) == 0
    import pickle
    assert pickle.loads(pickle.dumps(model))._codes is None


def test_batches_are_joined_whole():
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"a": pa.array(range(i, i + n), pa.int64())}) for i, n in ((0, 3), (3, 0), (3, 4), (7, 2), (9, 1))]
    got = list(B.joined(iter(batches), 5))
    assert [b.num_rows for b in got] == [7, 3] and [v for b in got for v in b.column("a").to_pylist()] == list(range(10))
    assert list(B.joined(iter([]), 5)) == []


def test_few_conditions_share_a_table_and_many_do_not():
    x, y = sample(2000, seed=13)
    for growth, shared in (("symmetric", True), ("level", False)):
        model, _ = grow(x, y, B.Settings(rounds=4, growth=growth, depth=5), 4)
        paths, expected = A.leaves(model)
        ready = A.Lookup(A.with_tables(paths), 5)
        assert (len(ready.tables) == len(model.trees)) == shared
        phi = A.attribute(ready, x[:8])
        assert np.allclose(phi, enumerated(model, x[:8]))
        assert np.allclose(A.attribute(ready, x).sum(axis=1) + expected, model.margins(x))


def test_nodes_of_few_rows_are_counted_by_narrower_bundles():
    assert [len(b.columns) for b in B.bundled(np.zeros((4, 50), np.uint8), np.array([9] * 4), B.NARROW)] == [2, 2]
    x, y = sample(n=3000, d=4, seed=7)
    x = np.hstack([x, np.random.default_rng(8).integers(0, 4, (3000, 8)).astype(float)])
    one, g = grow(x, y, B.Settings(rounds=1, depth=1))
    lay, w = B.Layout(np.arange(12), g.sizes), np.ones(3000)
    got = g._histogram(lay, np.arange(3000), np.full(15, 200), w, w)
    assert got.shape[:2] == (15, 2)  # rows are not counted where no setting asks for them
    for c in range(12):
        for k in (0, 7, 14):
            assert np.array_equal(got[k, 0, lay.start[c]:lay.start[c] + g.sizes[c] + 1], np.bincount(g.bins[c, k * 200:k * 200 + 200], None, g.sizes[c] + 1))
