"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixtures) and runs the
library operator on all rows.  Doubles are rounded to 6 digits only at the
very end, for the comparison with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortframe.functions.columns import round_doubles
from cohortframe.schema import DEFAULT_COLUMNS as C
from cohortframe.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# --------------------------------------------------------------- shared inputs

def encoded_cohort(spark, sf_dir):
    """Cohort rows with ordinal sleep/diet scores and 0/1 Yes/No flags --
    the input the feature operators expect (no imputation, so the NULL
    handling of every feature is exercised)."""
    from cohortframe.operators import encode
    df = fx.cohort(spark, sf_dir)
    df = encode.encode_ordinal(df)
    dic = encode.fit_label(df, [C.suicidal, C.family_history])
    return encode.apply_label(df, dic, [C.suicidal, C.family_history])


# --------------------------------------------------------------- E imputation

@query("impute_fit")
def q_impute_fit(spark, sf_dir):
    """Imputation statistics fitted on every cohort row."""
    from cohortframe.operators.impute import fit_impute
    return fit_impute(fx.cohort(spark, sf_dir))


@query("impute_apply")
def q_impute_apply(spark, sf_dir):
    """Fitted statistics applied to every row."""
    from cohortframe.operators.impute import apply_impute, fit_impute
    df = fx.cohort(spark, sf_dir)
    return apply_impute(df, fit_impute(df))


# --------------------------------------------------------------- G features

@query("feat_stress")
def q_feat_stress(spark, sf_dir):
    """G1 on the raw cohort columns (NULL-skipping row statistics)."""
    from cohortframe.operators.features import stress
    df = fx.cohort(spark, sf_dir).select(C.id, C.academic_pressure, C.work_pressure, C.financial_stress)
    return stress(df)


@query("pipeline_slice")
def q_pipeline_slice(spark, sf_dir):
    """Minimum slice: impute (fit on all rows) -> stress features -> mean
    stress index by label."""
    from cohortframe.operators.features import TOTAL_STRESS, stress
    from cohortframe.operators.impute import apply_impute, fit_impute
    df = fx.cohort(spark, sf_dir)
    out = stress(apply_impute(df, fit_impute(df)))
    return out.groupBy(C.label).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(TOTAL_STRESS).alias("avg_total_stress"))


@query("impute_structural_report")
def q_impute_structural(spark, sf_dir):
    """E5: structural NULLs kept, counted per cohort and column."""
    from cohortframe.operators.impute import structural_report
    return structural_report(fx.cohort(spark, sf_dir))


@query("impute_zero_structural")
def q_impute_zero(spark, sf_dir):
    """Other cohort's columns -> 0.0."""
    from cohortframe.operators.impute import impute_zero_structural
    df = fx.cohort(spark, sf_dir).select(C.id, C.cohort, *C.student_only, *C.professional_only)
    return impute_zero_structural(df)


@query("outlier_clip")
def q_outlier_clip(spark, sf_dir):
    """3 x IQR bounds tightened to the valid range, clip not drop."""
    from cohortframe.operators.impute import apply_clip, fit_clip
    df = fx.cohort(spark, sf_dir).select(C.id, C.hours, C.cgpa)
    return apply_clip(df, fit_clip(df))


@query("outlier_clip_counts")
def q_outlier_clip_counts(spark, sf_dir):
    """E13 report: rows outside the fitted bounds per column."""
    from cohortframe.operators.impute import clip_counts, fit_clip
    df = fx.cohort(spark, sf_dir)
    return clip_counts(df, fit_clip(df))


def _features_frame(spark, sf_dir, version="current"):
    from cohortframe.operators import features as G
    df = encoded_cohort(spark, sf_dir)
    params = G.fit_features(df)
    if version == "current":
        return G.all_features(df, params)
    return G.all_features_v1(df, params)


@query("fill_inf_null")
def q_fill_inf_null(spark, sf_dir):
    """After the current features, NULL -> training median; columns
    without a NULL in training get 0.0 at apply time."""
    from cohortframe.operators.impute import apply_fill, fit_fill
    df = _features_frame(spark, sf_dir)
    return apply_fill(df, fit_fill(df, exclude=(C.id, C.label)), exclude=(C.id, C.label))


@query("fill_for_model")
def q_fill_for_model(spark, sf_dir):
    """E15 + H8: training-median fill of the numeric columns with
    ``__missing`` indicators (for models that reject NULL)."""
    from cohortframe.operators.impute import fill_for_model, fit_fill
    df = fx.cohort(spark, sf_dir).select(C.id, C.label, *C.numeric_profile)
    return fill_for_model(df, fit_fill(df, exclude=(C.id, C.label)), exclude=(C.id, C.label))


# --------------------------------------------------------------- B profiling

@query("profile_columns")
def q_profile_columns(spark, sf_dir):
    from cohortframe.operators.profile import column_profile
    return column_profile(fx.cohort(spark, sf_dir))


@query("profile_describe")
def q_profile_describe(spark, sf_dir):
    from cohortframe.operators.profile import describe
    return describe(fx.cohort(spark, sf_dir))


@query("profile_class_balance")
def q_profile_class_balance(spark, sf_dir):
    from cohortframe.operators.profile import class_balance
    return class_balance(fx.cohort(spark, sf_dir), C.label)


@query("profile_missing")
def q_profile_missing(spark, sf_dir):
    from cohortframe.operators.profile import missing
    return missing(fx.cohort(spark, sf_dir))


@query("profile_missing_cohort")
def q_profile_missing_cohort(spark, sf_dir):
    from cohortframe.operators.profile import missing_by_cohort
    return missing_by_cohort(fx.cohort(spark, sf_dir))


@query("profile_missing_core")
def q_profile_missing_core(spark, sf_dir):
    from cohortframe.operators.profile import missing_core
    return missing_core(fx.cohort(spark, sf_dir))


@query("profile_value_counts")
def q_profile_value_counts(spark, sf_dir):
    from cohortframe.operators.profile import value_counts
    return value_counts(fx.cohort(spark, sf_dir))


@query("profile_correlation")
def q_profile_correlation(spark, sf_dir):
    from cohortframe.operators.profile import correlation
    return correlation(fx.cohort(spark, sf_dir))


@query("profile_target_corr")
def q_profile_target_corr(spark, sf_dir):
    from cohortframe.operators.profile import target_correlation
    return target_correlation(fx.cohort(spark, sf_dir))


@query("profile_by_target")
def q_profile_by_target(spark, sf_dir):
    from cohortframe.operators.profile import stats_by_target
    return stats_by_target(fx.cohort(spark, sf_dir))


@query("profile_histogram")
def q_profile_histogram(spark, sf_dir):
    from cohortframe.operators.profile import histogram
    return histogram(fx.cohort(spark, sf_dir))


@query("profile_box_stats")
def q_profile_box_stats(spark, sf_dir):
    from cohortframe.operators.profile import box_stats
    return box_stats(fx.cohort(spark, sf_dir))


@query("profile_summary")
def q_profile_summary(spark, sf_dir):
    from cohortframe.operators.profile import summary
    return summary(fx.cohort(spark, sf_dir))


@query("profile_cohort_rates")
def q_profile_cohort_rates(spark, sf_dir):
    from cohortframe.operators.profile import cohort_rates
    return cohort_rates(fx.cohort(spark, sf_dir))


# --------------------------------------------------------------- C cleaning

@query("clean_drop_columns")
def q_clean_drop_columns(spark, sf_dir):
    from cohortframe.operators.clean import drop_columns
    return drop_columns(fx.cohort(spark, sf_dir))


@query("clean_sparse_rows")
def q_clean_sparse_rows(spark, sf_dir):
    """C2 with threshold 0.2 (the fixture's widest row has 8 of 20 NULLs)."""
    from cohortframe.operators.clean import drop_sparse_rows
    return drop_sparse_rows(fx.cohort(spark, sf_dir), 0.2).select(C.id)


@query("clean_anomalous_rows")
def q_clean_anomalous_rows(spark, sf_dir):
    from cohortframe.operators.clean import drop_anomalous_rows
    return drop_anomalous_rows(fx.cohort(spark, sf_dir)).select(C.id)


@query("clean_anomalous_counts")
def q_clean_anomalous_counts(spark, sf_dir):
    from cohortframe.operators.clean import anomalous_counts
    return anomalous_counts(fx.cohort(spark, sf_dir))


@query("clean_whitelist")
def q_clean_whitelist(spark, sf_dir):
    from cohortframe.operators.clean import whitelist
    return whitelist(fx.cohort(spark, sf_dir).select(C.id, C.sleep, C.diet))


@query("clean_blacklist")
def q_clean_blacklist(spark, sf_dir):
    from cohortframe.operators.clean import blacklist
    return blacklist(fx.cohort(spark, sf_dir).select(C.id, C.profession))


@query("clean_substring_blacklist")
def q_clean_substring_blacklist(spark, sf_dir):
    """C6 on profession and, with the same patterns, on degree."""
    from cohortframe.operators.clean import INVALID_PROFESSION_PATTERNS, substring_blacklist
    df = fx.cohort(spark, sf_dir).select(C.id, C.profession, C.degree)
    return substring_blacklist(df, {C.profession: INVALID_PROFESSION_PATTERNS,
                                    C.degree: INVALID_PROFESSION_PATTERNS})


@query("clean_pattern_whitelist")
def q_clean_pattern_whitelist(spark, sf_dir):
    from cohortframe.operators.clean import pattern_whitelist
    return pattern_whitelist(fx.cohort(spark, sf_dir).select(C.id, C.degree))


@query("prepare_features")
def q_prepare_features(spark, sf_dir):
    """Default drop list, then id + features in training order + label."""
    from cohortframe.operators.clean import drop_columns, prepare_features
    return prepare_features(drop_columns(fx.cohort(spark, sf_dir)))


# --------------------------------------------------------------- D splitting

@query("split_stratified")
def q_split_stratified(spark, sf_dir):
    from cohortframe.operators.rank import split_stratified
    return split_stratified(fx.cohort(spark, sf_dir).select(C.id, C.label)).select(C.id, C.label, "split")


@query("split_random")
def q_split_random(spark, sf_dir):
    from cohortframe.operators.rank import split_random
    return split_random(fx.cohort(spark, sf_dir).select(C.id)).select(C.id, "split")


@query("folds_random")
def q_folds_random(spark, sf_dir):
    from cohortframe.operators.rank import assign_folds
    return assign_folds(fx.cohort(spark, sf_dir).select(C.id), k=5).select(C.id, "fold")


@query("folds_null_label")
def q_folds_null_label(spark, sf_dir):
    """D4 where every seventh label is missing: those rows are a stratum of their own."""
    from cohortframe.operators.rank import assign_folds
    df = fx.cohort(spark, sf_dir).select(C.id, F.when(F.col(C.id) % 7 != 0, F.col(C.label)).alias(C.label))
    return assign_folds(df, k=5, label_col=C.label).select(C.id, C.label, "fold")


@query("folds_stratified")
def q_folds_stratified(spark, sf_dir):
    from cohortframe.operators.rank import assign_folds
    return assign_folds(fx.cohort(spark, sf_dir).select(C.id, C.label), k=5, label_col=C.label) \
        .select(C.id, C.label, "fold")


@query("sample_exact")
def q_sample_exact(spark, sf_dir):
    """Exactly 2,000 rows (the attribution sample size)."""
    from cohortframe.operators.rank import sample_exact
    return sample_exact(fx.cohort(spark, sf_dir).select(C.id, C.label), 2000)


# --------------------------------------------------------------- F encoding

@query("encode_ordinal")
def q_encode_ordinal(spark, sf_dir):
    from cohortframe.operators.encode import encode_ordinal
    return encode_ordinal(fx.cohort(spark, sf_dir).select(C.id, C.sleep, C.diet))


def _label_input(spark, sf_dir):
    from cohortframe.operators.clean import drop_columns
    from cohortframe.operators.encode import encode_ordinal
    return encode_ordinal(drop_columns(fx.cohort(spark, sf_dir)))


@query("encode_label")
def q_encode_label(spark, sf_dir):
    """F2 fitted and applied on all rows (default drop list removed first)."""
    from cohortframe.operators.encode import apply_label, fit_label
    df = _label_input(spark, sf_dir)
    return apply_label(df, fit_label(df))


@query("encode_label_unseen")
def q_encode_label_unseen(spark, sf_dir):
    """F2 fitted on the students' rows only, applied to every row: unseen
    categories map to 'Unknown' (when it is a class) or to n."""
    from cohortframe.operators.encode import apply_label, fit_label
    df = _label_input(spark, sf_dir)
    return apply_label(df, fit_label(df.filter(F.col(C.cohort) == C.student)))


@query("encode_label_dictionary")
def q_encode_label_dictionary(spark, sf_dir):
    from cohortframe.operators.encode import fit_label
    return fit_label(_label_input(spark, sf_dir))


@query("encode_target_fit")
def q_encode_target_fit(spark, sf_dir):
    from cohortframe.operators.encode import fit_target
    return fit_target(fx.cohort(spark, sf_dir), C.profession, C.label)


@query("encode_target_apply")
def q_encode_target_apply(spark, sf_dir):
    """map fitted on the students' rows, applied to every row."""
    from cohortframe.operators.encode import apply_target, fit_target
    df = fx.cohort(spark, sf_dir).select(C.id, C.cohort, C.profession, C.label)
    enc = fit_target(df.filter(F.col(C.cohort) == C.student), C.profession, C.label)
    return apply_target(df, enc, C.profession, out="profession_te")


@query("encode_target_oof")
def q_encode_target_oof(spark, sf_dir):
    """out-of-fold encoding over 5 seeded folds, one pass."""
    from cohortframe.operators.encode import target_oof
    from cohortframe.operators.rank import assign_folds
    df = assign_folds(fx.cohort(spark, sf_dir).select(C.id, C.profession, C.label), k=5)
    return target_oof(df, C.profession, C.label, out="profession_te")


# --------------------------------------------------------------- G features

def _feat_query(fn_names, version="current", keep_inputs=False):
    def run(spark, sf_dir):
        from cohortframe.operators import features as G
        df = encoded_cohort(spark, sf_dir)
        base = set(df.columns)
        params = G.fit_features(df)
        for n in fn_names:
            f = getattr(G, n)
            df = f(df, params, C) if n.startswith("satisfaction") else f(df, cols=C)
        new = [c for c in df.columns if c not in base]
        return df.select(C.id, *new)
    return run


for _name, _fns in {
    "feat_lifestyle": ["lifestyle"],
    "feat_satisfaction": ["stress", "satisfaction"],
    "feat_risk": ["lifestyle", "stress", "risk"],
    "feat_stress_v1": ["stress_v1"],
    "feat_lifestyle_v1": ["lifestyle_v1"],
    "feat_satisfaction_v1": ["stress_v1", "satisfaction_v1"],
    "feat_risk_v1": ["stress_v1", "lifestyle_v1", "risk_v1"],
    "feat_interactions": ["stress", "interactions"],
    "feat_powers": ["stress", "powers"],
}.items():
    query(_name)(_feat_query(_fns))


@query("feat_all")
def q_feat_all(spark, sf_dir):
    """G12 (current) + E14 fill, numeric output columns."""
    from cohortframe.operators.impute import apply_fill, fit_fill
    df = _features_frame(spark, sf_dir, "current")
    df = apply_fill(df, fit_fill(df, exclude=(C.id, C.label)), exclude=(C.id, C.label))
    from cohortframe.functions.columns import numeric_columns
    return df.select(numeric_columns(df))


@query("feat_all_v1")
def q_feat_all_v1(spark, sf_dir):
    """G12 (older set), numeric output columns."""
    from cohortframe.functions.columns import numeric_columns
    df = _features_frame(spark, sf_dir, "v1")
    return df.select(numeric_columns(df))


@query("feat_none")
def q_feat_none(spark, sf_dir):
    from cohortframe.functions.columns import numeric_columns
    from cohortframe.operators.features import no_features
    df = no_features(encoded_cohort(spark, sf_dir))
    return df.select(numeric_columns(df))


# --------------------------------------------------------------- H scaling

@query("scale_standard")
def q_scale_standard(spark, sf_dir):
    from cohortframe.operators.scale import apply_scale, fit_scale
    df = fx.cohort(spark, sf_dir).select(C.id, C.label, *C.numeric_profile)
    return apply_scale(df, fit_scale(df, method="standard"), "standard")


@query("scale_robust")
def q_scale_robust(spark, sf_dir):
    from cohortframe.operators.scale import apply_scale, fit_scale
    df = fx.cohort(spark, sf_dir).select(C.id, C.label, *C.numeric_profile)
    return apply_scale(df, fit_scale(df, method="robust"), "robust")


@query("feat_missing_indicator")
def q_feat_missing_indicator(spark, sf_dir):
    from cohortframe.operators.scale import missing_indicators
    df = fx.cohort(spark, sf_dir).select(C.id, C.label, *C.numeric_profile)
    return missing_indicators(df)


# --------------------------------------------------------------- J evaluation

def _scored(spark, sf_dir):
    return fx.scored(spark, sf_dir)


@query("eval_confusion")
def q_eval_confusion(spark, sf_dir):
    from cohortframe.operators.evaluate import confusion_counts, confusion_long, predict_at
    return confusion_long(confusion_counts(predict_at(_scored(spark, sf_dir), 0.5), ["model"]), ["model"])


@query("eval_basic")
def q_eval_basic(spark, sf_dir):
    from cohortframe.operators.evaluate import basic_metrics, predict_at
    return basic_metrics(predict_at(_scored(spark, sf_dir), 0.5), ["model"])


@query("eval_auc")
def q_eval_auc(spark, sf_dir):
    from cohortframe.operators.evaluate import auc
    return auc(_scored(spark, sf_dir), ["model"])


@query("eval_class_report")
def q_eval_class_report(spark, sf_dir):
    from cohortframe.operators.evaluate import class_report, predict_at
    return class_report(predict_at(_scored(spark, sf_dir), 0.5), ["model"])


@query("eval_roc")
def q_eval_roc(spark, sf_dir):
    from cohortframe.operators.evaluate import roc_points
    return roc_points(_scored(spark, sf_dir), ["model"])


@query("eval_pr")
def q_eval_pr(spark, sf_dir):
    from cohortframe.operators.evaluate import pr_points
    return pr_points(_scored(spark, sf_dir), ["model"])


@query("eval_logloss")
def q_eval_logloss(spark, sf_dir):
    from cohortframe.operators.evaluate import log_loss
    return log_loss(_scored(spark, sf_dir), ["model"])


def _members_long(spark, sf_dir):
    """Three member scores as a long (id, label, model, score) table."""
    m = fx.members(spark, sf_dir)
    return m.select("id", "label", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(f"score_{n}").alias("score")) for n in ("a", "b", "c")])))


def _members_sets(spark, sf_dir):
    """Member scores with a seeded stratified train/validation split."""
    from cohortframe.operators.rank import split_stratified
    m = split_stratified(fx.members(spark, sf_dir), "id", "label", 0.2, 55, "dataset")
    m = m.withColumn("dataset", F.when(F.col("dataset") == "val", "Validation").otherwise("Train"))
    return m.select("id", "label", "dataset", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(f"score_{n}").alias("score")) for n in ("a", "b", "c")])))


@query("eval_all")
def q_eval_all(spark, sf_dir):
    """Every metric for every (model, dataset) in one plan."""
    from cohortframe.operators.evaluate import evaluate_all
    return evaluate_all(_members_sets(spark, sf_dir), ["model", "dataset"]).drop("tn", "fp", "fn", "tp")


@query("eval_compare")
def q_eval_compare(spark, sf_dir):
    from cohortframe.operators.evaluate import compare_models, evaluate_all, metrics_long
    wide = evaluate_all(_members_sets(spark, sf_dir), ["model", "dataset"])
    return compare_models(metrics_long(wide))


@query("eval_best_model")
def q_eval_best_model(spark, sf_dir):
    from cohortframe.operators.evaluate import best_model, evaluate_all
    return best_model(evaluate_all(_members_sets(spark, sf_dir), ["model", "dataset"]))


@query("thr_sweep")
def q_thr_sweep(spark, sf_dir):
    from cohortframe.operators.evaluate import threshold_sweep
    return threshold_sweep(_scored(spark, sf_dir), ["model"])


@query("thr_best")
def q_thr_best(spark, sf_dir):
    from cohortframe.operators.evaluate import best_threshold, threshold_sweep
    return best_threshold(threshold_sweep(_scored(spark, sf_dir), ["model"]), ["model"], "f1")


@query("thr_eval")
def q_thr_eval(spark, sf_dir):
    from cohortframe.operators.evaluate import best_threshold, evaluate_at, threshold_sweep
    s = _scored(spark, sf_dir)
    best = best_threshold(threshold_sweep(s, ["model"]), ["model"])
    return evaluate_at(s, best, ["model"]).drop("tn", "fp", "fn", "tp")


@query("thr_compare")
def q_thr_compare(spark, sf_dir):
    from cohortframe.operators.evaluate import compare_thresholds
    return compare_thresholds(_scored(spark, sf_dir)).drop("tn", "fp", "fn", "tp")


@query("thr_all_models")
def q_thr_all_models(spark, sf_dir):
    """Best F1 threshold of each of the three member models."""
    from cohortframe.operators.evaluate import best_threshold, threshold_sweep
    return best_threshold(threshold_sweep(_members_long(spark, sf_dir), ["model"]), ["model"])


# --------------------------------------------------------------- I14-I16

@query("ensemble_average")
def q_ensemble_average(spark, sf_dir):
    """Mean of the members' probabilities, label at 0.5."""
    from cohortframe.operators.models import ensemble_mean
    e = ensemble_mean(fx.members(spark, sf_dir), ["score_a", "score_b", "score_c"])
    return e.select("id", "label", "ensemble_score", (F.col("ensemble_score") >= 0.5).cast("int").alias("prediction"))


@query("ensemble_threshold")
def q_ensemble_threshold(spark, sf_dir):
    """Mean of the members' best thresholds."""
    from cohortframe.operators.evaluate import best_threshold, threshold_sweep
    from cohortframe.operators.models import ensemble_threshold
    best = best_threshold(threshold_sweep(_members_long(spark, sf_dir), ["model"]), ["model"])
    return ensemble_threshold(best)


@query("predict_distribution")
def q_predict_distribution(spark, sf_dir):
    """I16: count and percent per predicted class at the ensemble threshold."""
    from cohortframe.operators.models import ensemble_predict, prediction_distribution
    pred = ensemble_predict(fx.members(spark, sf_dir), ["score_a", "score_b", "score_c"],
                            _ens_threshold(spark, sf_dir))
    return prediction_distribution(pred)


def _ens_threshold(spark, sf_dir):
    from cohortframe.operators.evaluate import best_threshold, threshold_sweep
    from cohortframe.operators.models import ensemble_threshold
    best = best_threshold(threshold_sweep(_members_long(spark, sf_dir), ["model"]), ["model"])
    return ensemble_threshold(best).first()["threshold"]


@query("predict_submission")
def q_predict_submission(spark, sf_dir):
    """(id, label) rows of the ensemble prediction."""
    from cohortframe.operators.models import ensemble_predict
    pred = ensemble_predict(fx.members(spark, sf_dir), ["score_a", "score_b", "score_c"],
                            _ens_threshold(spark, sf_dir))
    return pred.select("id", F.col("prediction").alias("label"))


# --------------------------------------------------------------- L validation

@query("validate_output")
def q_validate_output(spark, sf_dir):
    """L1: ensemble submission checked against the order ids."""
    from cohortframe.operators.models import ensemble_predict
    from cohortframe.operators.validate import validate_output
    from cohortframe.sources.tables import read_table
    pred = ensemble_predict(fx.members(spark, sf_dir), ["score_a", "score_b", "score_c"],
                            _ens_threshold(spark, sf_dir))
    sub = pred.select("id", F.col("prediction").alias("label"))
    sample = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                                         F.lit(0).alias("label"))
    return validate_output(sub, sample)


# --------------------------------------------------------------- I models

# The registered queries train with the library's defaults, which are the full
# settings.
_SHARED: dict = {}
BOOSTERS = ("gbt_a", "gbt_b", "gbt_c")


def _shared(spark, sf_dir, what, make):
    """Made once a session: the model queries read one preparation and one set of models."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def _plain(spark, sf_dir):
    """Prepared without oversampling, for what folds the training rows."""
    from cohortframe.plans.pipeline import prepare
    return _shared(spark, sf_dir, "plain", lambda: prepare(fx.cohort(spark, sf_dir), smote=False))


def _prepared(spark, sf_dir):
    from cohortframe.plans.pipeline import oversampled
    return _shared(spark, sf_dir, "prepared", lambda: oversampled(_plain(spark, sf_dir)))


def _boosted(spark, sf_dir):
    """The three boosters, trained side by side; their histories have validation losses."""
    from cohortframe.operators.models import BOOSTED, fit_boosted
    prep = _prepared(spark, sf_dir)
    return _shared(spark, sf_dir, "boosted", lambda: fit_boosted(prep.train, prep.features, {k: BOOSTED[k] for k in BOOSTERS}, C.label, prep.val))


def _model(spark, sf_dir, kind):
    from cohortframe.operators.models import fit_model
    if kind in BOOSTERS:
        return _boosted(spark, sf_dir)[kind]
    prep = _prepared(spark, sf_dir)
    return _shared(spark, sf_dir, kind, lambda: fit_model(prep.train, prep.features, kind, C.label))


def _models(spark, sf_dir, kinds=("logistic", "forest", *BOOSTERS)):
    return {k: _model(spark, sf_dir, k) for k in kinds}


def _model_query(kind):
    def run(spark, sf_dir):
        from cohortframe.operators.models import score
        return score(_model(spark, sf_dir, kind), _prepared(spark, sf_dir).val, keep=[C.id, C.label])
    run.__doc__ = f"I1-I5: {kind} trained on the prepared training split, validation rows scored (I13)."
    return run


for _k in ("logistic", "forest", *BOOSTERS):
    query(f"model_{_k}")(_model_query(_k))


@query("predict_scores")
def q_predict_scores(spark, sf_dir):
    """Probability and label at 0.5 for every validation row, three boosters."""
    from cohortframe.operators.models import score
    out = None
    for k in ("gbt_a", "gbt_b", "gbt_c"):
        s = score(_model(spark, sf_dir, k), _prepared(spark, sf_dir).val, keep=[C.id, C.label]).withColumn("model", F.lit(k))
        out = s if out is None else out.unionByName(s)
    return out


@query("predict_new_rows")
def q_predict_new_rows(spark, sf_dir):
    """Raw rows + fitted parameters + models + tuned thresholds -> submission:
    the raw cohort rows without their label, scored end to end (A6, I13-I15)."""
    from cohortframe.plans.pipeline import predict, score_long, tune
    from cohortframe.session import compiled_methods, cut_lineage
    prep, fitted = _prepared(spark, sf_dir), _models(spark, sf_dir, ("gbt_a", "gbt_b", "gbt_c"))
    thresholds = tune(score_long(fitted, prep, C.id, C.label), C.label)
    raw = fx.cohort(spark, sf_dir).drop(C.label).repartition(C.id)  # scoring takes far longer than reading, so it is not left to a scan's few tasks
    with compiled_methods(spark):  # the parameters' projections run here; two columns are kept
        return cut_lineage(predict(raw, prep, fitted, thresholds).select(C.id, "prediction"))


@query("predict_new_rows_count")
def q_predict_new_rows_count(spark, sf_dir):
    """Every raw row is scored once and gets a label of {0, 1}."""
    p = q_predict_new_rows(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(C.id).alias("ids"),
                 F.count_if(F.col("prediction").isin(0, 1)).alias("labelled"))


@query("stream_predict")
def q_stream_predict(spark, sf_dir):
    """New raw rows arriving as files, scored by a stream with the whole fitted pipeline: rows, and how many differ from the batch."""
    import uuid
    from cohortframe.plans.pipeline import predict, score_long, tune
    from cohortframe.session import compiled_methods, cut_lineage, scratch_path
    from cohortframe.streaming.scoring import score_stream
    prep, fitted = _prepared(spark, sf_dir), _models(spark, sf_dir, BOOSTERS)
    thresholds = cut_lineage(tune(score_long(fitted, prep, C.id, C.label), C.label))  # the stream's batches and the whole table read them
    raw = fx.cohort(spark, sf_dir).drop(C.label)
    name = f"predict-{uuid.uuid4().hex}"
    source, sink = scratch_path(spark, f"{name}-in"), scratch_path(spark, f"{name}-out")
    raw.repartition(4).write.parquet(source)
    scored = lambda rows: predict(rows.repartition(C.id), prep, fitted, thresholds)  # noqa: E731 -- scoring takes far longer than reading, so it is not left to a file's task
    with compiled_methods(spark):  # the stream's session starts with this one's settings
        stream = score_stream(spark, source, raw.schema, scored, sink, name=name)
        stream.awaitTermination()
        found = spark.read.parquet(sink).select(C.id, F.col("score").alias("stream_score"), F.col("prediction").alias("stream_prediction"))
        j = scored(raw).join(found, C.id, "full_outer")
        same = F.col("prediction").eqNullSafe(F.col("stream_prediction")) & F.col("score").eqNullSafe(F.col("stream_score"))
        return cut_lineage(j.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("unequal")))


@query("metrics_calibrated")
def q_metrics_calibrated(spark, sf_dir):
    """I18 with a calibration split: training stops and thresholds are tuned on rows that no figure of the validation rows is taken from."""
    from cohortframe.plans.pipeline import pipeline_metrics, prepare
    prep = prepare(fx.cohort(spark, sf_dir), smote=False, calibration=0.5)
    return pipeline_metrics(fx.cohort(spark, sf_dir), kinds=BOOSTERS, prep=prep, patience=50)


@query("thr_models")
def q_thr_models(spark, sf_dir):
    """J15/I15 on the trained models: tuned threshold of each model and of the ensemble."""
    from cohortframe.plans.pipeline import score_long, tune
    return tune(score_long(_models(spark, sf_dir), _prepared(spark, sf_dir), C.id, C.label), C.label)


@query("train_early_stop")
def q_train_early_stop(spark, sf_dir):
    """Patience rule on per-round validation loss; the model is cut at the best round."""
    from cohortframe.operators.models import history_frame, train_early_stop
    prep = _prepared(spark, sf_dir)
    model, hist, best = train_early_stop(prep.train, prep.val, prep.features, "gbt_a", C.label)
    h = history_frame(spark, hist, "gbt_a")
    return h.withColumn("best_iteration", F.lit(best)).withColumn("kept_rounds", F.lit(len(model.trees)))


@query("train_history")
def q_train_history(spark, sf_dir):
    """Per-round losses of the boosters plus single-point train/val
    log-loss rows of the logistic and forest models, and the summary."""
    from cohortframe.operators.models import history_frame, history_summary, logloss
    prep = _prepared(spark, sf_dir)
    hist = None
    for k, m in _boosted(spark, sf_dir).items():
        h = history_frame(spark, m.history, k)
        hist = h if hist is None else hist.unionByName(h)
    rows = [(k, 1, logloss(m, prep.train), logloss(m, prep.val)) for k, m in _models(spark, sf_dir, ("logistic", "forest")).items()]
    allh = hist.unionByName(spark.createDataFrame(rows, hist.schema))
    return allh.join(history_summary(allh), "model")


def _folded(spark, sf_dir):
    """Training rows in five stratified folds, and the oversampling of each fold's training part."""
    from cohortframe.operators.rank import assign_folds
    from cohortframe.plans.pipeline import fold_oversampler
    prep = _plain(spark, sf_dir)
    return assign_folds(prep.train, C.id, 5, 55, C.label), prep.features, fold_oversampler(prep)


@query("cv_scores")
def q_cv_scores(spark, sf_dir):
    """Stratified 5-fold CV, mean +- 2 std of positive-class F1; oversampled inside the folds."""
    from cohortframe.operators.models import cross_validate, mean_and_range
    folded, features, oversample = _folded(spark, sf_dir)
    out = mean_and_range(cross_validate(folded, features, "gbt_c", "fold", C.label, oversample=oversample))
    return spark.createDataFrame([("gbt_c", *out)], "model string, mean_f1 double, std_f1 double, lo double, hi double")


def _search_query(kind):
    def run(spark, sf_dir):
        from cohortframe.operators.models import search_params
        folded, features, oversample = _folded(spark, sf_dir)
        return search_params(folded, features, kind, label=C.label, oversample=oversample)
    run.__doc__ = f"I10: Parzen search over all of {kind}'s ranges, scored by CV F1, oversampled inside the folds."
    return run


for _name, _k in (("search_params", "gbt_c"), ("search_params_a", "gbt_a"), ("search_params_b", "gbt_b")):
    query(_name)(_search_query(_k))


def _rates(spark, sf_dir):
    from cohortframe.operators.models import rate_results
    from cohortframe.session import cut_lineage
    prep = _prepared(spark, sf_dir)
    return _shared(spark, sf_dir, "rates", lambda: cut_lineage(rate_results(
        prep.train, prep.val, prep.features, id_col=C.id, label=C.label)))


@query("search_learning_rate")
def q_search_learning_rate(spark, sf_dir):
    """Every rate of the sweep with early stopping; accuracy, F1, AUC and rounds per rate."""
    return _rates(spark, sf_dir)


@query("best_learning_rate")
def q_best_learning_rate(spark, sf_dir):
    """Best rate for each metric, the first one wins ties."""
    from cohortframe.operators.models import best_rates
    return best_rates(_rates(spark, sf_dir))


@query("compare_learning_rates")
def q_compare_learning_rates(spark, sf_dir):
    """Three chosen rates side by side, best accuracy first."""
    from cohortframe.operators.models import compare_rates
    return compare_rates(_rates(spark, sf_dir), [0.07, 0.1, 0.3])


@query("pipeline_metrics")
def q_pipeline_metrics(spark, sf_dir):
    """The full pipeline -- prepare with oversampling, five models and the
    ensemble, metrics and tuned threshold per (model, dataset)."""
    from cohortframe.plans.pipeline import pipeline_metrics
    return pipeline_metrics(fx.cohort(spark, sf_dir), prep=_prepared(spark, sf_dir), fitted=_models(spark, sf_dir))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Save models and metadata, reload, re-score: rows and how many scores differ."""
    import os
    import uuid
    from cohortframe.operators.models import check_metadata, load_models, save_metadata, save_models, score
    from cohortframe.session import scratch_path
    prep, m = _prepared(spark, sf_dir), _model(spark, sf_dir, "gbt_c")
    path = scratch_path(spark, f"models-{os.getpid()}-{uuid.uuid4().hex[:8]}")
    save_models({"gbt_c": m}, path)
    save_metadata(spark, path, "current", prep.features)
    check_metadata(spark, path, "current")
    back = load_models(spark, path, ["gbt_c", "absent"])["gbt_c"]
    a = score(m, prep.val, keep=[C.id]).select(C.id, F.col("score").alias("score_before"))
    b = score(back, prep.val, keep=[C.id]).select(C.id, F.col("score").alias("score_after"))
    return a.join(b, C.id).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score_before") != F.col("score_after")).alias("unequal"))


# --------------------------------------------------------------- A sources

def _duplicated(spark, sf_dir):
    from cohortframe.sources.tables import read_table
    sample = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit(0).alias("label"))
    return sample.union(sample.filter("id % 10 = 0")), sample


@query("validate_output_duplicates")
def q_validate_output_duplicates(spark, sf_dir):
    """L1 on a submission that repeats every tenth id."""
    from cohortframe.operators.validate import validate_output
    return validate_output(*_duplicated(spark, sf_dir))


@query("validate_many")
def q_validate_many(spark, sf_dir):
    """L2: a right submission and one with repeated ids."""
    from cohortframe.operators.validate import validate_many, validate_output
    return validate_many([q_validate_output(spark, sf_dir), validate_output(*_duplicated(spark, sf_dir), name="repeated")])


@query("stage_roundtrip")
def q_stage_roundtrip(spark, sf_dir):
    """A2: a split stage table written partitioned by split, the validation
    partition read back (partition pruning)."""
    import os
    import uuid
    from cohortframe.operators.rank import split_stratified
    from cohortframe.session import scratch_path
    from cohortframe.sources.tables import read_stage, write_stage
    df = split_stratified(fx.cohort(spark, sf_dir).select(C.id, C.label, C.age, C.hours))
    path = scratch_path(spark, f"stage-{os.getpid()}-{uuid.uuid4().hex[:8]}")
    write_stage(df, path)
    return read_stage(spark, path, "val").select(C.id, C.label, C.age, C.hours)


@query("params_roundtrip")
def q_params_roundtrip(spark, sf_dir):
    """A3: imputation parameter table written and read back."""
    import os
    import uuid
    from cohortframe.operators.impute import fit_impute
    from cohortframe.session import scratch_path
    from cohortframe.sources.tables import read_params, write_params
    path = scratch_path(spark, f"params-{os.getpid()}-{uuid.uuid4().hex[:8]}")
    write_params(fit_impute(fx.cohort(spark, sf_dir)), path)
    return read_params(spark, path)


@query("scan_csv_roundtrip")
def q_scan_csv_roundtrip(spark, sf_dir):
    """A1/A5: the cohort table written as header CSV, scanned back with an
    explicit schema (NaN/empty -> NULL)."""
    import os
    import uuid
    from cohortframe.session import scratch_path
    from cohortframe.sources.tables import read_csv, write_csv
    df = fx.cohort(spark, sf_dir)
    path = scratch_path(spark, f"csv-{os.getpid()}-{uuid.uuid4().hex[:8]}")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


# --------------------------------------------------------------- K attribution

def _standin_phi(spark, sf_dir):
    """Stand-in attribution table (FIXTURES 2.4): unpivot of the scaled
    numeric cohort columns as (id, cohort, model, feature, phi), two
    'models' (standard and robust scaling)."""
    from cohortframe.operators.scale import apply_scale, fit_scale
    df = fx.cohort(spark, sf_dir).select(C.id, C.cohort, *C.numeric_profile)
    out = None
    for method in ("standard", "robust"):
        s = apply_scale(df, fit_scale(df, list(C.numeric_profile), method), method)
        long = s.select(C.id, C.cohort, F.lit(method).alias("model"), F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).alias("phi")) for f in C.numeric_profile])))
        out = long if out is None else out.unionByName(long)
    return out.filter(F.col("phi").isNotNull())


@query("attr_importance")
def q_attr_importance(spark, sf_dir):
    """K4: mean |phi| per feature and rank, per model."""
    from cohortframe.operators.attribute import importance
    return importance(_standin_phi(spark, sf_dir), ["model"])


@query("attr_ensemble")
def q_attr_ensemble(spark, sf_dir):
    """K5: mean over models of the per-model importance."""
    from cohortframe.operators.attribute import ensemble_importance, importance
    return ensemble_importance(importance(_standin_phi(spark, sf_dir), ["model"]))


@query("attr_dependence")
def q_attr_dependence(spark, sf_dir):
    """K6: (id, value, phi) of age under the standard model."""
    from cohortframe.operators.attribute import dependence
    phi = _standin_phi(spark, sf_dir).filter(F.col("model") == "standard")
    return dependence(fx.cohort(spark, sf_dir), phi, C.age)


@query("select_top_n")
def q_select_top_n(spark, sf_dir):
    """K7: the 5 most important features kept (same list for any split)."""
    from cohortframe.operators.attribute import importance, select_top_n
    imp = importance(_standin_phi(spark, sf_dir).filter(F.col("model") == "standard"))
    kept = select_top_n(fx.cohort(spark, sf_dir), imp, 5, keep=(C.id,))
    feats = [c for c in kept.columns if c != C.id]
    # long form so the kept column set itself is compared
    return kept.select(C.id, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in feats])))


def _cohort_imps(spark, sf_dir):
    from cohortframe.operators.attribute import importance
    phi = _standin_phi(spark, sf_dir).filter(F.col("model") == "standard")
    a = importance(phi.filter(F.col(C.cohort) == C.student))
    b = importance(phi.filter(F.col(C.cohort) == C.professional))
    return a, b


@query("cohort_compare")
def q_cohort_compare(spark, sf_dir):
    """K9: students vs professionals, full outer join, missing -> 0."""
    from cohortframe.operators.attribute import compare_cohorts
    return compare_cohorts(*_cohort_imps(spark, sf_dir))


@query("cohort_top_union")
def q_cohort_top_union(spark, sf_dir):
    """Union of both cohorts' top 15, by mean importance."""
    from cohortframe.operators.attribute import top_union
    return top_union(*_cohort_imps(spark, sf_dir), 15)


@query("cohort_top_diff")
def q_cohort_top_diff(spark, sf_dir):
    """Inner join, top 10 differences each way."""
    from cohortframe.operators.attribute import top_differences
    return top_differences(*_cohort_imps(spark, sf_dir), 10)


@query("attr_linear")
def q_attr_linear(spark, sf_dir):
    """K2: exact attributions of the logistic model on the validation rows."""
    from cohortframe.operators.attribute import linear_attributions, mean_background
    prep = _prepared(spark, sf_dir)
    return linear_attributions(_model(spark, sf_dir, "logistic"), prep.val, prep.features, mean_background(prep.train, prep.features))


ATTR_ROWS = 2000


@query("attr_shapley")
def q_attr_shapley(spark, sf_dir):
    """K1: exact tree attributions of a booster on sampled validation rows."""
    from cohortframe.operators.rank import sample_exact
    from cohortframe.operators.shapley import tree_attributions
    prep = _prepared(spark, sf_dir)
    return tree_attributions({"gbt_a": _model(spark, sf_dir, "gbt_a")}, sample_exact(prep.val, ATTR_ROWS), C.id).drop("model")


@query("attr_shapley_sum")
def q_attr_shapley_sum(spark, sf_dir):
    """K1: of every validation row and booster, whether the attributions add up to the margin less the expected one."""
    from cohortframe.operators.boosting import with_margins
    from cohortframe.operators.shapley import expected_margin, tree_attributions
    fitted = _boosted(spark, sf_dir)
    val = _prepared(spark, sf_dir).val
    sums = tree_attributions(fitted, val, C.id).groupBy(C.id, "model").agg(F.sum("phi").alias("total"))
    margins = with_margins(val, fitted, [C.id])
    long = margins.select(C.id, F.inline(F.array(*[F.struct(F.lit(k).alias("model"), (F.col(k) - F.lit(expected_margin(m))).alias("margin")) for k, m in fitted.items()])))
    return long.join(sums, [C.id, "model"]).groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("margin") - F.col("total")) > 1e-6).alias("unequal"))


#: Rows that the kernel attributions explain: each is scored some 100,000 times.
KERNEL_ROWS = 10


@query("attr_kernel")
def q_attr_kernel(spark, sf_dir):
    """K1: kernel attributions of the logistic model against 50 weighted centres, beside the exact linear ones from the centres' mean (K2)."""
    from cohortframe.operators.attribute import background_summary, linear_attributions
    from cohortframe.operators.models import margin
    from cohortframe.operators.rank import sample_exact
    from cohortframe.operators.shapley import kernel_attributions
    prep, model = _prepared(spark, sf_dir), _model(spark, sf_dir, "logistic")
    centres = background_summary(prep.train, prep.features, 50)
    some = sample_exact(prep.val, KERNEL_ROWS)
    mean = centres.agg(*[F.sum(F.col(f) * F.col("weight")).alias(f) for f in prep.features]).first().asDict()
    phi = kernel_attributions(lambda df, keep: margin(model, df, keep), some, prep.features, centres, C.id)
    exact = linear_attributions(model, some, prep.features, mean).withColumnRenamed("phi", "linear")
    return phi.join(exact, [C.id, "feature"])


@query("attr_background")
def q_attr_background(spark, sf_dir):
    """K3: 50 weighted k-means centres of the training features."""
    from cohortframe.operators.attribute import background_summary
    prep = _prepared(spark, sf_dir)
    return background_summary(prep.train, prep.features, 50)


@query("cohort_study")
def q_cohort_study(spark, sf_dir):
    """K8: per cohort -- own split and fitted preparation (cohort column
    dropped), three boosters, exact attributions of all validation rows,
    importance averaged over the boosters."""
    from cohortframe.operators.attribute import importance
    from cohortframe.operators.clean import cohort_filter
    from cohortframe.operators.models import BOOSTED, fit_boosted
    from cohortframe.operators.shapley import tree_attributions
    from cohortframe.plans.pipeline import prepare
    df = fx.cohort(spark, sf_dir)
    out = None
    for who in (C.student, C.professional):
        prep = prepare(cohort_filter(df, who, C), smote=False)
        feats = [f for f in prep.features if f != C.cohort]  # the cohort column is removed
        fitted = fit_boosted(prep.train, feats, {k: BOOSTED[k] for k in BOOSTERS}, C.label)
        imp = importance(tree_attributions(fitted, prep.val, C.id), ["model"]).withColumn(C.cohort, F.lit(who))
        out = imp if out is None else out.unionByName(imp)
    return out.groupBy(C.cohort, "feature").agg(F.avg("importance").alias("importance"))


# --------------------------------------------------------------- H resampling

@query("resample_smote")
def q_resample_smote(spark, sf_dir):
    """H4/H7: prepared training rows oversampled to balance."""
    from cohortframe.operators.resample import smote
    prep = _prepared(spark, sf_dir)
    return smote(prep.train, prep.features, C.label, C.id)


@query("resample_smote_null")
def q_resample_smote_null(spark, sf_dir):
    """H5: raw numeric cohort columns with structural NULLs: sentinel
    before, NULL restored after."""
    from cohortframe.operators.resample import smote
    df = fx.cohort(spark, sf_dir).select(C.id, C.label, *C.numeric_profile)
    return smote(df, list(C.numeric_profile), C.label, C.id, sentinel_nulls=True)


@query("resample_tomek")
def q_resample_tomek(spark, sf_dir):
    """H6 link step on the embeddings table: mutual nearest neighbours of
    different labels."""
    from cohortframe.operators.resample import tomek_links
    from cohortframe.sources.tables import read_table
    wide, feats = _vectors(read_table(spark, sf_dir, "embeddings"))
    return tomek_links(wide, feats, "label", "id")


def _vectors(emb):
    dims = len(emb.select("embedding").first()[0])
    feats = [f"e{i}" for i in range(dims)]
    return emb.select(F.col("vec_id").alias("id"), "label", *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(feats)]), feats


@query("resample_tomek_removed")
def q_resample_tomek_removed(spark, sf_dir):
    """H6 removal step on the embeddings table: rows in no link."""
    from cohortframe.operators.resample import remove_links
    from cohortframe.sources.tables import read_table
    wide, feats = _vectors(read_table(spark, sf_dir, "embeddings"))
    return remove_links(wide, feats, "label", "id").select("id", "label")


@query("resample_smote_tomek")
def q_resample_smote_tomek(spark, sf_dir):
    """H6: prepared training rows oversampled, then without Tomek links."""
    from cohortframe.operators.resample import smote_tomek
    prep = _prepared(spark, sf_dir)
    return smote_tomek(prep.train, prep.features, C.label, C.id)


@query("resample_counts")
def q_resample_counts(spark, sf_dir):
    """H7: rows of each class after oversampling with NULLs."""
    return q_resample_smote_null(spark, sf_dir).groupBy(C.label, "synthetic").agg(F.count(F.lit(1)).alias("n"))
