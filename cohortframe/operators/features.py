"""Feature construction.

Each function appends columns with one projection and emits only the
features whose inputs exist.  Inputs are the encoded table: ordinal sleep
(1..5) and diet (0..3) scores, 0/1 flags for the Yes/No columns.

Current set: G1 stress, G2 lifestyle, G3 satisfaction, G4 risk (NULL-skipping
row statistics).  Older set: G6-G11 (NULL-propagating arithmetic,
interactions and powers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortframe.functions.columns import (flag, plain_max, plain_mean, plain_var_pop, present,
                                           row_max, row_mean, row_var_pop, safe_div, safe_name)
from cohortframe.operators.quantiles import exact_quantiles
from cohortframe.params import ALL, Params, long_params
from cohortframe.schema import DEFAULT_COLUMNS, Columns

FEAT_STAGE = "features"

# Output names of the constructed features.
TOTAL_STRESS = "total_stress_index"
MAX_STRESS = "max_stress"
STRESS_VAR = "stress_variance"
STRESS_SAT = "stress_saturated"
WLB = "work_life_balance"
OVERWORK = "overwork_flag"
HOURS_SAT = "hours_saturated"
SLEEP_OPT = "sleep_optimal"
SLEEP_POOR = "sleep_poor"
DIET_BAD = "diet_unhealthy"
DIET_GOOD = "diet_healthy"
OVERALL_SAT = "overall_satisfaction"
LOW_SAT_HIGH_STRESS = "low_satisfaction_high_stress"
HIGH_ACHIEVER = "high_achiever"
TOTAL_RISK = "total_risk_factors"
SUICIDAL_FAMILY = "suicidal_family_risk"
OVERWORK_STRESS = "overwork_high_stress"
YOUTH = "youth_risk"
ACADEMIC_INTENSITY = "academic_intensity"
WORK_INTENSITY = "work_intensity"
LIFESTYLE_SCORE = "lifestyle_score"
SAT_STRESS_RATIO = "satisfaction_stress_ratio"
FAMILY_STRESS = "family_stress_interaction"
AGE_STRESS = "age_stress_interaction"

# Feature thresholds of the current and older feature sets.
OVERWORK_HOURS = 10
SLEEP_OPTIMAL_CODE = 5
SLEEP_POOR_CODE = 1
DIET_UNHEALTHY_CODE = 3
DIET_HEALTHY_CODE = 0
LOW_SATISFACTION = 2.0
HIGH_STRESS = 3.0
YOUTH_AGE = 30


def _add(df: DataFrame, new: list[Column]) -> DataFrame:
    return df.select("*", *new) if new else df


def _stress_inputs(df, cols):
    return present(df, [cols.academic_pressure, cols.work_pressure, cols.financial_stress])


# ---------------------------------------------------------------- current set

def stress(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """G1: mean, max, population variance and log1p(mean) over the available
    stress components, all skipping NULL."""
    s = _stress_inputs(df, cols)
    if not s:
        return df
    mean = row_mean(s)
    return _add(df, [mean.alias(TOTAL_STRESS), row_max(s).alias(MAX_STRESS),
                     row_var_pop(s).alias(STRESS_VAR), F.log1p(mean).alias(STRESS_SAT)])


def lifestyle(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Hours balance / overwork / saturation, sleep and diet flags."""
    new = []
    if cols.hours in df.columns:
        h = F.col(cols.hours).cast("double")
        new += [safe_div(F.lit(1.0), h + 1).alias(WLB), flag(h >= OVERWORK_HOURS).alias(OVERWORK),
                F.log1p(h).alias(HOURS_SAT)]
    if cols.sleep in df.columns:
        new += [flag(F.col(cols.sleep) == SLEEP_OPTIMAL_CODE).alias(SLEEP_OPT),
                flag(F.col(cols.sleep) == SLEEP_POOR_CODE).alias(SLEEP_POOR)]
    if cols.diet in df.columns:
        new += [flag(F.col(cols.diet) == DIET_UNHEALTHY_CODE).alias(DIET_BAD),
                flag(F.col(cols.diet) == DIET_HEALTHY_CODE).alias(DIET_GOOD)]
    return _add(df, new)


def fit_features(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Training statistic of the satisfaction features: the CGPA median."""
    if cols.cgpa not in df.columns:
        return long_params(df.limit(0).agg(F.lit(None).alias("x")), FEAT_STAGE, [])
    one = df.sparkSession.range(1).select(F.lit(_frame_median(df, cols)).cast("double").alias("m"))
    return long_params(one, FEAT_STAGE, [("m", cols.cgpa, ALL, "median", False)])


def _frame_median(df, cols):
    return exact_quantiles(df, {"m": (F.col(cols.cgpa), [0.5])})[()]["m"][0]


def _cgpa_median(df, params, cols):
    if params is not None:
        p = params if isinstance(params, Params) else Params.collect(params, FEAT_STAGE)
        if p.has(FEAT_STAGE, cols.cgpa, ALL, "median"):
            return p.value(FEAT_STAGE, cols.cgpa, ALL, "median")
    # no stored statistic: the median of the frame itself (a fitted scalar)
    return _frame_median(df, cols)


def satisfaction(df: DataFrame, params=None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """NULL-skipping satisfaction mean, low-satisfaction-high-stress
    flag, CGPA at or above the training median (NULL counts as 0.0)."""
    s = present(df, [cols.study_satisfaction, cols.job_satisfaction])
    new = []
    if s:
        m = row_mean(s)
        new.append(m.alias(OVERALL_SAT))
        if TOTAL_STRESS in df.columns:
            new.append(flag((m < LOW_SATISFACTION) & (F.col(TOTAL_STRESS) > HIGH_STRESS))
                       .alias(LOW_SAT_HIGH_STRESS))
    if cols.cgpa in df.columns:
        med = _cgpa_median(df, params, cols)
        new.append(flag(F.col(cols.cgpa) >= F.lit(med).cast("double")).cast("double").alias(HIGH_ACHIEVER))
    return _add(df, new)


def risk(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Risk-factor count and products, youth flag."""
    have = set(df.columns)
    factors = [c for c in (cols.suicidal, cols.family_history, OVERWORK) if c in have]
    new = []
    if factors:
        tot = F.col(factors[0])
        for c in factors[1:]:
            tot = tot + F.col(c)
        new.append(tot.alias(TOTAL_RISK))
    if cols.suicidal in have and cols.family_history in have:
        new.append((F.col(cols.suicidal) * F.col(cols.family_history)).alias(SUICIDAL_FAMILY))
    if OVERWORK in have and TOTAL_STRESS in have:
        new.append((F.col(OVERWORK) * F.col(TOTAL_STRESS)).alias(OVERWORK_STRESS))
    if cols.age in have:
        new.append(flag(F.col(cols.age) <= YOUTH_AGE).alias(YOUTH))
    return _add(df, new)


def all_features(df: DataFrame, params=None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """G12 (current): stress -> lifestyle -> satisfaction -> risk.  The
    interaction and polynomial steps of the current set are no-ops by
    design (G5)."""
    df = stress(df, cols)
    df = lifestyle(df, cols)
    df = satisfaction(df, params, cols)
    return risk(df, cols)


def no_features(df: DataFrame, *_, **__) -> DataFrame:
    """The no-engineering baseline."""
    return df


# ------------------------------------------------------------------ older set

def stress_v1(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Plain mean / max / population variance (NULL propagates) and
    pressure x hours intensities."""
    s = _stress_inputs(df, cols)
    new = []
    if s:
        new += [plain_mean(s).alias(TOTAL_STRESS), plain_max(s).alias(MAX_STRESS),
                plain_var_pop(s).alias(STRESS_VAR)]
    if cols.hours in df.columns:
        h = F.col(cols.hours)
        if cols.academic_pressure in df.columns:
            new.append((F.col(cols.academic_pressure) * h).alias(ACADEMIC_INTENSITY))
        if cols.work_pressure in df.columns:
            new.append((F.col(cols.work_pressure) * h).alias(WORK_INTENSITY))
    return _add(df, new)


def lifestyle_v1(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Hours balance, overwork flag, mean of sleep and diet scores."""
    new = []
    if cols.hours in df.columns:
        h = F.col(cols.hours).cast("double")
        new += [safe_div(F.lit(1.0), h + 1).alias(WLB), flag(h >= OVERWORK_HOURS).alias(OVERWORK)]
    comps = present(df, [cols.sleep, cols.diet])
    if comps:
        new.append(plain_mean(comps).alias(LIFESTYLE_SCORE))
    return _add(df, new)


def satisfaction_v1(df: DataFrame, params=None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Plain satisfaction mean, (sat+1)/(stress+1), CGPA >= median."""
    s = present(df, [cols.study_satisfaction, cols.job_satisfaction])
    new = []
    if s:
        m = plain_mean(s)
        new.append(m.alias(OVERALL_SAT))
        if TOTAL_STRESS in df.columns:
            new.append(safe_div(m + 1, F.col(TOTAL_STRESS) + 1).alias(SAT_STRESS_RATIO))
    if cols.cgpa in df.columns:
        med = _cgpa_median(df, params, cols)
        new.append(flag(F.col(cols.cgpa) >= F.lit(med).cast("double")).alias(HIGH_ACHIEVER))
    return _add(df, new)


def risk_v1(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Family x stress, youth flag, age x stress (age alone when there
    is no stress index), risk-factor count."""
    have = set(df.columns)
    new = []
    if cols.family_history in have and TOTAL_STRESS in have:
        new.append((F.col(cols.family_history) * F.col(TOTAL_STRESS)).alias(FAMILY_STRESS))
    if cols.age in have:
        new.append(flag(F.col(cols.age) <= YOUTH_AGE).alias(YOUTH))
        age_stress = (F.col(cols.age) * F.col(TOTAL_STRESS)) if TOTAL_STRESS in have else F.col(cols.age)
        new.append(age_stress.alias(AGE_STRESS))
    factors = [c for c in (cols.suicidal, cols.family_history, OVERWORK) if c in have]
    if factors:
        tot = F.col(factors[0])
        for c in factors[1:]:
            tot = tot + F.col(c)
        new.append(tot.alias(TOTAL_RISK))
    return _add(df, new)


def default_pairs(cols: Columns = DEFAULT_COLUMNS) -> list[tuple[str, str]]:
    """G10 pairs of the older feature set."""
    return [(cols.academic_pressure, cols.hours), (cols.work_pressure, cols.hours),
            (cols.financial_stress, cols.hours), (cols.age, cols.academic_pressure),
            (cols.age, cols.work_pressure), (cols.suicidal, TOTAL_STRESS)]


def interactions(df: DataFrame, pairs: list[tuple[str, str]] | None = None,
                 cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Products of the listed pairs, named ``a_x_b`` (blanks and '/'
    become '_', '?' removed)."""
    pairs = default_pairs(cols) if pairs is None else pairs
    have = set(df.columns)
    new = [(F.col(a) * F.col(b)).alias(safe_name(f"{a}_x_{b}"))
           for a, b in pairs if a in have and b in have]
    return _add(df, new)


def powers(df: DataFrame, features: list[str] | None = None, degree: int = 2,
           cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """``x_pow2 .. x_pow<degree>`` for each listed column."""
    features = [cols.age, cols.hours, TOTAL_STRESS] if features is None else features
    new = [F.pow(F.col(f), F.lit(float(d))).alias(f"{f}_pow{d}")
           for f in present(df, features) for d in range(2, degree + 1)]
    return _add(df, new)


def all_features_v1(df: DataFrame, params=None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """G12 (older): stress -> lifestyle -> satisfaction -> risk ->
    interactions -> powers."""
    df = stress_v1(df, cols)
    df = lifestyle_v1(df, cols)
    df = satisfaction_v1(df, params, cols)
    df = risk_v1(df, cols)
    df = interactions(df, None, cols)
    return powers(df, None, 2, cols)
