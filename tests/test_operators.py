"""Unit tests on small hand-made tables: the semantic rules of SURVEY 1.4
and the invariants of section 5."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortframe.functions.columns import row_max, row_mean, row_var_pop
from cohortframe.operators import clean, encode, evaluate, impute, rank, resample, scale
from cohortframe.schema import DEFAULT_COLUMNS as C


def test_row_stats_skip_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 2.0, 5.0)], "a double, b double, c double")
    r = df.select(row_mean(["a", "b", "c"]).alias("m"), row_max(["a", "b", "c"]).alias("x"),
                  row_var_pop(["a", "b", "c"]).alias("v")).collect()
    assert r[0]["m"] == 2.0 and r[0]["x"] == 3.0 and r[0]["v"] == 1.0
    assert r[1]["m"] is None and r[1]["x"] is None and r[1]["v"] is None
    assert r[2]["m"] == 3.0 and math.isclose(r[2]["v"], 2.0)


def _cohort_rows(spark):
    rows = [
        (1, "Student", None, 2.0, None, "Healthy"),
        (2, "Student", "X", None, None, "Healthy"),
        (3, "Working Professional", None, None, 4.0, None),
        (4, "Working Professional", "B", None, 2.0, "Moderate"),
        (5, "Working Professional", "A", None, None, "Moderate"),
        (6, "Student", None, 4.0, None, "Unhealthy"),
    ]
    return spark.createDataFrame(rows, "id long, cohort string, profession string, academic_pressure double, "
                                       "work_pressure double, dietary_habits string")


def test_impute_fit_apply(spark):
    df = _cohort_rows(spark)
    p = impute.fit_impute(df)
    out = {r["id"]: r for r in impute.apply_impute(df, p).collect()}
    assert out[1]["profession"] == "Student"               # E6
    assert out[3]["profession"] == "A"                     # E8: tie A/B -> smallest
    assert out[2]["academic_pressure"] == 3.0              # E7 student median of 2, 4
    assert out[3]["academic_pressure"] is None             # structural, kept
    assert out[5]["work_pressure"] == 3.0                  # professional median of 4, 2
    assert out[1]["work_pressure"] is None                 # structural, kept
    assert out[3]["dietary_habits"] in ("Healthy", "Moderate")  # E10 mode (tie -> smallest)
    assert out[3]["dietary_habits"] == "Healthy"


def test_apply_without_fit_raises(spark):
    df = _cohort_rows(spark)
    with pytest.raises(ValueError):
        impute.apply_impute(df, impute.Params([]))


def test_fit_on_train_only(spark):
    """Changing validation rows never changes the fitted parameters."""
    df = _cohort_rows(spark)
    a = sorted(map(tuple, impute.fit_impute(df.filter("id <= 4")).collect()))
    other = df.filter("id > 4").withColumn("academic_pressure", F.lit(99.0))
    b = sorted(map(tuple, impute.fit_impute(df.filter("id <= 4").unionByName(other.limit(0))).collect()))
    assert a == b


def test_clip_keeps_null_and_is_idempotent(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)] + [(9, 90.0), (10, None)], "id long, hours double")
    p = impute.fit_clip(df, {"hours": (0.0, 24.0)})
    once = impute.apply_clip(df, p)
    twice = impute.apply_clip(once, p)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    vals = {r["id"]: r["hours"] for r in once.collect()}
    assert vals[10] is None and vals[9] == 19.0  # Q3 7 + 3 x IQR 4


def test_fill_stored_null_stays_null(spark):
    train = spark.createDataFrame([(1, None, 1.0), (2, None, None)], "id long, a double, b double")
    p = impute.fit_fill(train, exclude=("id",))
    test = spark.createDataFrame([(3, None, None)], "id long, a double, b double")
    r = impute.apply_fill(test, p, exclude=("id",)).first()
    assert r["a"] is None and r["b"] == 1.0


def test_label_encode_unseen(spark):
    tr = spark.createDataFrame([("b",), ("a",), (None,)], "g string")
    d = encode.fit_label(tr, ["g"])
    te = spark.createDataFrame([("a",), ("z",), (None,)], "g string")
    got = [r[0] for r in encode.apply_label(te, d, ["g"]).collect()]
    assert got == [0, 3, 2]  # a -> 0, unseen -> n = 3, NULL -> 'nan' (index 2)


def test_target_encoding(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "c string, label int")
    enc = encode.fit_target(df, "c", "label", smoothing=10)
    m = {r["value_str"]: r["value"] for r in enc.collect()}
    g = 0.75
    assert math.isclose(m["a"], (1 + g * 10) / 12) and math.isclose(m[None], g)
    new = spark.createDataFrame([("zz",)], "c string")
    assert math.isclose(encode.apply_target(new, enc, "c").first()[0], g)


def test_split_sizes_and_partition_invariance(spark):
    df = spark.range(1, 1001).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    a = rank.split_stratified(df.repartition(1))
    b = rank.split_stratified(df.repartition(7))
    sa = sorted(map(tuple, a.collect()))
    assert sa == sorted(map(tuple, b.collect()))
    val = a.filter("split = 'val'")
    assert val.count() == 200
    assert val.filter("label = 1").count() in (28, 29)


def test_folds_balanced(spark):
    df = spark.range(1, 501).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    f = rank.assign_folds(df, k=5, label_col="label")
    counts = [r[1] for r in f.groupBy("fold").count().collect()]
    assert sorted(counts) == [100] * 5


def test_sparse_rows_default(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None)], "id long, a double, b double")
    assert [r[0] for r in clean.drop_sparse_rows(df).collect()] == [2]  # 2/3 missing >= 0.5 dropped, 1/3 kept


def test_auc_matches_bruteforce(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.2), (1, 0.2), (0, 0.1), (1, 0.7)]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("model", F.lit("m"))
    got = evaluate.auc(df, ["model"]).first()["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(got, want)


def test_best_threshold_smallest_on_ties(spark):
    sw = spark.createDataFrame([("m", 0.3, 0.5), ("m", 0.2, 0.5), ("m", 0.4, 0.1)], "model string, threshold double, f1 double")
    assert evaluate.best_threshold(sw).first()["best_threshold"] == 0.2
    zero = spark.createDataFrame([("m", 0.3, 0.0)], "model string, threshold double, f1 double")
    assert evaluate.best_threshold(zero).first()["best_threshold"] == 0.5


def test_scale_rules(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (9.0,)], "x double")
    r = sorted(x[0] for x in scale.apply_scale(df, scale.fit_scale(df, ["x"], "robust"), "robust").collect())
    assert math.isclose(r[1], (2.0 - 2.5) / 2.75)
    with pytest.raises(ValueError):
        scale.fit_scale(df, ["x"], "minmax")
    assert scale.apply_scale(df, None, "none") is df


def test_smote_segments(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i <= 12)) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    out = resample.smote(df, ["a", "b"], "label", "id", k=3)
    counts = {r[0]: r[1] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 48
    orig = out.filter("synthetic = 0")
    assert sorted(map(tuple, orig.select("id", "a", "b", "label").collect())) == sorted(rows)
    mins = [(a, b) for _, a, b, y in rows if y == 1]
    lo_a, hi_a = min(m[0] for m in mins), max(m[0] for m in mins)
    for r in out.filter("synthetic = 1").collect():
        assert lo_a - 1e-9 <= r["a"] <= hi_a + 1e-9


def test_knn_exact(spark):
    rows = [(i, float(i), 0.0) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    nn = resample.knn(df, df, ["a", "b"], k=2, cell_rows=3, block_rows=2)
    got = {(r["id"], r["nb_rank"]): r["nb_id"] for r in nn.collect()}
    assert got[(1, 1)] == 2 and got[(1, 2)] == 3 and got[(10, 1)] == 9 and got[(10, 2)] == 11


# ------------------------------------------------------------ wrong answers that once passed

def test_folds_keep_rows_without_a_label(spark):
    from cohortframe.operators.rank import assign_folds, split_stratified
    df = spark.range(100).select("id", F.when(F.col("id") >= 20, (F.col("id") % 2).cast("int")).alias("label"))
    assert assign_folds(df, "id", 5, 55, "label").count() == 100
    assert split_stratified(df, "id", "label").count() == 100


def test_curves_refuse_missing_scores_and_keep_null_groups(spark):
    from cohortframe.operators.evaluate import roc_points
    rows = [(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.8), ("a", 0, 0.3)]
    pts = roc_points(spark.createDataFrame(rows, "model string, label int, score double"), ["model"]).collect()
    assert len(pts) == 6 and sum(p["fpr"] == 0.0 and p["tpr"] == 0.0 for p in pts) == 2
    with pytest.raises(Exception, match="NULL or NaN"):
        roc_points(spark.createDataFrame([("a", 1, None), ("a", 0, 0.1)], "model string, label int, score double"), ["model"]).collect()


def test_integer_columns_are_not_truncated(spark):
    from cohortframe.operators import impute
    from cohortframe.params import ALL, Params
    fill = Params([{"stage": impute.STAGE, "feature": "age", "cohort": ALL, "stat": "median", "value": 1.5, "value_str": None}])
    df = spark.createDataFrame([(1, "Student", None), (2, "Student", 4)], "id long, cohort string, age int")
    assert {r["id"]: r["age"] for r in impute.apply_impute(df, fill).collect()} == {1: 1.5, 2: 4.0}
    clip = Params([{"stage": impute.CLIP_STAGE, "feature": "age", "cohort": ALL, "stat": s, "value": v, "value_str": None} for s, v in (("lo", 0.0), ("hi", 16.75))])
    assert impute.apply_clip(spark.createDataFrame([(1, 40)], "id long, age int"), clip).first()["age"] == 16.75


def test_smote_draws_every_synthetic_row(spark):
    from cohortframe.operators import resample
    rows = [(i, 1, float(i), float(i % 3)) for i in range(12)] + [(i, 0, float(i), 0.0) for i in range(12, 60)]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double")
    for k in (3, 50):  # more neighbours asked than there are
        out = resample.smote(df, ["a", "b"], "label", "id", k=k)
        assert out.filter("synthetic = 1").count() == 36
    gaps = df.withColumn("a", F.when(F.col("id") > 2, F.col("a")))
    assert resample.smote(gaps, ["a", "b"], "label", "id", sentinel_nulls=True).filter("synthetic = 1").count() == 36
    with pytest.raises(Exception, match="no distance"):
        resample.smote(gaps, ["a", "b"], "label", "id").collect()


def test_validator_counts_each_side(spark):
    from cohortframe.operators.validate import validate_output
    sub = spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "id long, label int")
    sample = spark.createDataFrame([(1, 0), (2, 0)], "id long, label int")
    got = {r["check"]: r["passed"] for r in validate_output(sub, sample).collect()}
    assert not got["row_count"] and not got["unique_ids"] and not got["ids"]
    got = {r["check"]: r["passed"] for r in validate_output(sample.drop("label"), sample).collect()}
    assert not got["columns"] and not got["binary_labels"]


def test_registered_queries_use_the_full_settings(monkeypatch):
    import inspect
    import types
    from cohortframe.operators import attribute, models, rank, search, shapley
    from cohortframe.plans import pipeline, queries

    assert {k: s.rounds for k, s in models.BOOSTED.items()} == dict.fromkeys(("gbt_a", "gbt_b", "gbt_c"), 500)
    assert search.TRIALS == 50 and models.PATIENCE == 50 and len(models.LEARNING_RATES) == 7

    class Asked(Exception):
        pass

    def asked(run, module, name):
        def stop(*a, **k):
            raise Asked(bound.bind(*a, **k).arguments)
        with monkeypatch.context() as m:
            bound = inspect.signature(getattr(module, name))
            m.setattr(module, name, stop)
            with pytest.raises(Asked) as got:
                run(None, "x")
        return got.value.args[0]

    prep = types.SimpleNamespace(train=None, val="all rows", features=["a"])
    monkeypatch.setattr(queries, "_prepared", lambda *a: prep)
    monkeypatch.setattr(queries, "_plain", lambda *a: prep)
    monkeypatch.setattr(queries, "_shared", lambda spark, sf_dir, what, make: make())
    monkeypatch.setattr(queries.fx, "cohort", lambda *a: types.SimpleNamespace(filter=lambda c: None))
    monkeypatch.setattr(queries, "F", types.SimpleNamespace(col=lambda c: c))
    monkeypatch.setattr(pipeline, "prepare", lambda *a, **k: prep)
    cuts = {"rounds", "depth", "patience", "max_rounds", "rates", "n_trials", "override", "space"}
    q = queries.QUERIES
    for k in ("gbt_a", "gbt_b", "gbt_c"):
        assert asked(q[f"model_{k}"], models, "fit_boosted")["wanted"] == models.BOOSTED
    assert not cuts & set(asked(q["train_early_stop"], models, "train_early_stop"))
    assert not cuts & set(asked(q["search_learning_rate"], models, "rate_results"))
    for name in ("cv_scores", "search_params", "search_params_a", "search_params_b"):
        assert asked(q[name], rank, "assign_folds")["k"] == 5
    monkeypatch.setattr(rank, "assign_folds", lambda *a: None)
    assert not cuts & set(asked(q["cv_scores"], models, "cross_validate"))
    for name, kind in (("search_params", "gbt_c"), ("search_params_a", "gbt_a"), ("search_params_b", "gbt_b")):
        searched = asked(q[name], models, "search_params")
        assert not cuts & set(searched) and searched["kind"] == kind and searched.get("n_folds", 5) == 5 and searched["oversample"]
    monkeypatch.setattr(queries, "_model", lambda *a: None)
    assert asked(q["attr_shapley"], rank, "sample_exact")["n"] == 2000
    monkeypatch.setattr("cohortframe.operators.clean.cohort_filter", lambda *a: None)
    assert asked(q["cohort_study"], models, "fit_boosted")["wanted"] == models.BOOSTED
    monkeypatch.setattr(models, "fit_boosted", lambda *a: None)
    assert asked(q["cohort_study"], shapley, "tree_attributions")["df"] == "all rows"


def test_a_failing_trial_keeps_the_others(spark, monkeypatch):
    from cohortframe.operators import models

    def scores(table, features, tried, n_folds, grouped):
        if any(s.depth == 7 for s in tried):
            raise RuntimeError("lost")
        return [[0.7, 0.8] for _ in tried]
    monkeypatch.setattr(models, "boosted_folds", lambda *a: None)
    monkeypatch.setattr(models, "_fold_scores", scores)
    rows = models.search_params(spark.range(1), [], "gbt_c", n_trials=12, space={"depth": ("int", 6, 8)}).collect()
    assert {r["mean_f1"] for r in rows} == {0.75, 0.0} and all(("lost" in (r["error"] or "")) == (r["mean_f1"] == 0.0) == ('"depth": 7' in r["params"]) for r in rows)


def test_metadata_guards_the_feature_set(spark, tmp_path):
    from cohortframe.operators.models import check_metadata, save_metadata
    save_metadata(spark, str(tmp_path), "current", ["a", "b"])
    assert check_metadata(spark, str(tmp_path), "current") == ["a", "b"]
    with pytest.raises(ValueError):
        check_metadata(spark, str(tmp_path), "none")
    with pytest.raises(Exception):
        check_metadata(spark, str(tmp_path / "absent"), "current")


def test_only_a_local_master_may_make_its_own_folder():
    from cohortframe.session import is_local
    assert is_local("local[4]") and is_local("local")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("spark://host:7077") and not is_local("yarn")


def test_long_dictionaries_are_ranked_in_many_buckets(spark):
    from cohortframe.operators import encode
    df = spark.range(20_000).select("id", F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("city"))
    dic = encode.fit_label(df, ["city"])
    got = [r["value_str"] for r in dic.orderBy("value").collect()]
    assert got == sorted(got) and len(got) == 20_000
    distinct = df.select(F.lit("city").alias("feature"), F.col("city").alias("value_str"))
    assert distinct.select(encode._text_bucket(distinct).alias("b")).distinct().count() > 30
    out = encode.apply_label(df.limit(100), dic, ["city"])
    assert sorted(r["city"] for r in out.collect()) == sorted(int(r["id"]) for r in out.collect())


def test_projection_forest_finds_most_neighbours(spark):
    import numpy as np
    from cohortframe.operators.resample import knn, knn_forest, recall
    rng = np.random.default_rng(5)
    n, d = 3000, 35
    x = rng.normal(size=(n, 6)) @ rng.normal(size=(6, d)) + 0.1 * rng.normal(size=(n, d))  # few true dimensions among many columns
    feats = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *feats]).cache()
    exact = knn(df, df, feats, 5).cache()
    found = knn_forest(df, df, feats, 5, leaf_rows=200)
    assert recall(found, exact) >= 0.9
    assert found.filter("id = nb_id").isEmpty() and found.groupBy("id").count().filter("count > 5").isEmpty()
    # equal vectors, in blocks on both sides
    same = spark.range(300).select("id", *[F.lit(1.0).alias(f) for f in feats[:3]])
    got = {(r["id"], r["nb_id"]) for r in knn(same, same, feats[:3], 2, block_rows=40).collect()}
    assert got == {(i, j) for i in range(300) for j in [j for j in (0, 1, 2) if j != i][:2]}


def test_long_lists_of_invalid_values_are_joined(spark):
    from cohortframe.operators.clean import blacklist_table
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (5, "a")], "id long, p string")
    bad = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "value string")
    assert sorted((r["id"], r["p"]) for r in blacklist_table(df, "p", bad).collect()) == [(1, None), (2, "b"), (3, None), (4, None), (5, None)]
    assert blacklist_table(df, "p", bad.limit(0)).filter("p is not null").count() == 4


def test_encoder_selection(spark):
    from cohortframe.operators import encode
    rows = [(1, "x", "Less than 5 hours", 1), (2, "y", "7-8 hours", 0), (3, "x", None, 1), (4, None, "5-6 hours", 0)]
    df = spark.createDataFrame(rows, "id long, profession string, sleep_duration string, label int")
    out, params = encode.encode(df, None, "target")
    assert {r["stage"] for r in params.select("stage").distinct().collect()} >= {"encode_target"} or params.filter("feature = 'profession'").count() > 0
    by = {r["id"]: r for r in out.collect()}
    assert by[1]["profession"] == by[3]["profession"] > by[2]["profession"]
    again, _ = encode.encode(df.drop("label"), params, "target", fit=False)
    assert {r["id"]: r["profession"] for r in again.collect()} == {i: r["profession"] for i, r in by.items()}
    plain, _ = encode.encode(df.drop("label"), None, "target")  # no label to learn from: label encoding
    assert {r["id"]: r["profession"] for r in plain.collect()}[1] != by[1]["profession"] or by[1]["profession"] in (0, 1)
    with pytest.raises(ValueError):
        encode.encode(df, None, "other")


def test_cohort_filter(spark):
    from cohortframe.operators.clean import cohort_filter
    df = spark.createDataFrame([(1, "Student"), (2, "Working Professional"), (3, None)], "id long, cohort string")
    assert [r["id"] for r in cohort_filter(df, "Student").collect()] == [1]


def _nearest_by_trying(x, k):
    out = set()
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 9)
        d[i] = np.inf
        out |= {(i, int(j), r + 1) for r, j in enumerate(np.lexsort((np.arange(len(x)), d))[:k])}
    return out


@pytest.mark.parametrize("width, distinct", [(12, 10**6), (2, 6), (4, 50)])
def test_neighbours_of_any_width_are_those_of_trying_all(spark, width, distinct):
    from cohortframe.operators import resample as R
    x = np.random.default_rng(width).integers(0, distinct, (600, width)).astype(float)
    x[-1] = -9 * distinct  # stretches its cell
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"f{i} double" for i in range(width)))
    found = R.knn(df, df, [f"f{i}" for i in range(width)], 3, cell_rows=40, block_rows=150).collect()
    assert {(r["id"], r["nb_id"], r["nb_rank"]) for r in found} == _nearest_by_trying(x, 3) and len(found) == 1800


def test_a_row_is_sent_to_packs_where_bounds_leave_all_cells():
    from cohortframe.operators import resample as R
    pack = R._packs(np.array([5, 0, 4, 3, 20, 1, 9]), 10)
    assert pack.tolist() == [0, 0, 0, 1, 2, 3, 3]
    assert R._packs(np.full(100, 2000), R.BLOCK_ROWS)[-1] == 24


def test_copies_of_equal_rows_cost_no_loop_over_rows():
    import time
    from cohortframe.operators import resample as R
    x = np.random.default_rng(0).normal(size=(8000, 8))
    ids = np.arange(8000)
    at = time.monotonic()
    found = R._nearest(ids, x, ids, x, 5, True)
    assert len(found) == 40_000 and time.monotonic() - at < 30
    twice = R._nearest(np.array([1, 2]), np.zeros((2, 3)), np.array([2, 1, 7, 1]), np.zeros((4, 3)), 2, True)
    assert list(zip(twice["id"], twice["nb_id"])) == [(1, 2), (1, 7), (2, 1), (2, 1)]


def _students(spark, n=80):
    return spark.range(n).selectExpr(
        "id", "cast(id % 3 = 0 as int) as label", "if(id % 2 = 0, 'Student', 'Working Professional') as cohort", "cast(18 + id % 40 as double) as age",
        "cast(id % 13 as double) as hours", "if(id % 2 = 0, 5 + id % 5, null) * 1.0D as cgpa", "if(id % 4 = 0, 'Yes', 'No') as suicidal")


def test_preparation_runs_in_methods_that_the_jvm_compiles(spark, monkeypatch):
    from cohortframe.params import Params
    from cohortframe.plans import pipeline
    from cohortframe.session import COMPILED_BYTES, METHOD_LIMIT
    seen, cut, before = [], pipeline.cut_lineage, spark.conf.get(METHOD_LIMIT)
    monkeypatch.setattr(pipeline, "cut_lineage", lambda df: (seen.append(int(spark.conf.get(METHOD_LIMIT))), cut(df))[1])
    prep = pipeline.prepare(_students(spark), smote=False)
    assert seen and max(seen) <= COMPILED_BYTES
    assert spark.conf.get(METHOD_LIMIT) == before
    # the scaler is collected once: applying it again does not scan the training rows
    assert isinstance(prep.params["scale"], Params) and prep.params["scale"]


def test_method_limit_returns_after_an_error(spark):
    from cohortframe.session import COMPILED_BYTES, METHOD_LIMIT, compiled_methods
    before = spark.conf.get(METHOD_LIMIT)
    with pytest.raises(ValueError):
        with compiled_methods(spark):
            assert int(spark.conf.get(METHOD_LIMIT)) <= COMPILED_BYTES
            raise ValueError
    assert spark.conf.get(METHOD_LIMIT) == before


def test_new_rows_are_scored_by_more_tasks_than_read_them(spark, monkeypatch):
    from cohortframe.plans import pipeline, queries
    rows = _students(spark).coalesce(1)
    prep = pipeline.prepare(rows, smote=False)
    fitted = pipeline.train_all(prep, ("gbt_a",), rounds=2)
    planned, predict = [], pipeline.predict
    monkeypatch.setattr(queries, "_prepared", lambda *a: prep)
    monkeypatch.setattr(queries, "_models", lambda *a: fitted)
    monkeypatch.setattr(queries.fx, "cohort", lambda *a: rows)
    monkeypatch.setattr(pipeline, "predict", lambda df, *a: (planned.append(df), predict(df, *a))[1])
    got = {tuple(r) for r in queries.q_predict_new_rows(spark, "").collect()}
    assert "Repartition" in planned[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(got) == 80 and {r[0] for r in got} == set(range(80))
    long = pipeline.score_long(fitted, prep)
    assert got == {(r["id"], r["prediction"]) for r in predict(rows.drop("label"), prep, fitted, pipeline.tune(long)).collect()}


def test_streamed_rows_are_scored_by_more_tasks_than_files_and_thresholds_are_tuned_once(spark, monkeypatch):
    from cohortframe.plans import pipeline, queries
    from cohortframe.session import COMPILED_BYTES, METHOD_LIMIT
    rows = _students(spark).coalesce(1)
    prep = pipeline.prepare(rows, smote=False)
    fitted = pipeline.train_all(prep, ("gbt_a",), rounds=2)
    planned, predict = [], pipeline.predict

    def noted(df, p, f, thresholds):
        planned.append([d._jdf.queryExecution().optimizedPlan().toString() for d in (df, thresholds)] + [int(df.sparkSession.conf.get(METHOD_LIMIT))])
        return predict(df, p, f, thresholds)

    monkeypatch.setattr(queries, "_prepared", lambda *a: prep)
    monkeypatch.setattr(queries, "_models", lambda *a: fitted)
    monkeypatch.setattr(queries.fx, "cohort", lambda *a: rows)
    monkeypatch.setattr(pipeline, "predict", noted)
    assert queries.q_stream_predict(spark, "").first().asDict() == {"n": 80, "unequal": 0}
    assert len(planned) == 2
    for rows_plan, thresholds_plan, limit in planned:
        assert "Repartition" in rows_plan and "MapInArrow" not in thresholds_plan and limit <= COMPILED_BYTES
