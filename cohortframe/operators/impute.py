"""Imputation and outliers.

Fit steps are single aggregation jobs over the training rows; apply steps
are single projections with the fitted values as literals.

Structural vs anomalous missingness: students lack the professional-only
columns and professionals the student-only ones *by design*; those NULLs are
kept (and counted).  A NULL where the cohort should have a value is
anomalous and is filled with the cohort's training median (or mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortframe.functions.columns import (clean_doubles, nan_to_null, numeric_columns,
                                           present, string_columns)
from cohortframe.operators.quantiles import exact_quantiles, quantile_frame
from cohortframe.params import ALL, Params, empty_params, long_params
from cohortframe.schema import DEFAULT_COLUMNS, Columns

STAGE = "impute"
UNKNOWN = "Unknown"


def _medians(df: DataFrame, exprs: dict, approx: bool) -> DataFrame:
    """One row with the median of each expression under its name."""
    if approx:
        return df.agg(*[F.percentile_approx(x, 0.5, 10000).cast("double").alias(a) for a, x in exprs.items()])
    got = exact_quantiles(df, {a: (x, [0.5]) for a, x in exprs.items()})[()]
    return df.sparkSession.range(1).select(*[F.lit(got[a][0]).cast("double").alias(a) for a in exprs])


def _modes(df: DataFrame, keyed: list[tuple[str, object]], spark) -> DataFrame:
    """Most frequent non-NULL value per key, smallest value on ties.

    ``keyed``: (key, column expression).  The string columns are unpivoted
    and counted with a map-side partial aggregation, so the shuffle carries
    one row per distinct (key, value) and per task -- scalable in both rows
    and cardinality, unlike a per-column in-memory frequency map.
    """
    if not keyed:
        return None
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), e.cast("string").alias("v")) for k, e in keyed])))
    counts = stacked.filter(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("k").agg(F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v"))).alias("mode"))
    keys = spark.createDataFrame([(k,) for k, _ in keyed], "k string")
    return keys.join(best, "k", "left").select("k", F.coalesce("mode", F.lit(UNKNOWN)).alias("mode"))


def fit_impute(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, approx: bool = False) -> DataFrame:
    """Cohort medians, global medians, modes and the professionals'
    profession mode, as one parameter table."""
    df = clean_doubles(df)
    is_s = F.col(cols.cohort) == cols.student
    is_p = F.col(cols.cohort) == cols.professional
    aggs, specs = {}, []
    # Anomalous-missing statistics of the cohort-specific columns
    for c in present(df, cols.student_only):
        a = f"{c}__s"
        aggs[a] = F.when(is_s, F.col(c))
        specs.append((a, c, cols.student, "median", False))
    for c in present(df, cols.professional_only):
        a = f"{c}__p"
        aggs[a] = F.when(is_p, F.col(c))
        specs.append((a, c, cols.professional, "median", False))
    # Every numeric column except id and target
    for c in numeric_columns(df, exclude=(cols.id, cols.label)):
        a = f"{c}__all"
        aggs[a] = F.col(c)
        specs.append((a, c, ALL, "median", False))
    spark = df.sparkSession
    med = long_params(_medians(df, aggs, approx), STAGE, specs) if aggs else empty_params(spark)
    # modes
    keyed = [(c, F.col(c)) for c in string_columns(df, exclude=(cols.id, cols.name, cols.profession))]
    if cols.profession in df.columns:
        keyed.append((f"{cols.profession}@{cols.professional}", F.when(is_p, F.col(cols.profession))))
    modes = _modes(df, keyed, spark)
    if modes is None:
        return med
    split = F.split(F.col("k"), "@")
    modes = modes.select(
        F.lit(STAGE).alias("stage"), split[0].alias("feature"),
        F.when(F.size(split) > 1, split[1]).otherwise(F.lit(ALL)).alias("cohort"),
        F.lit("mode").alias("stat"), F.lit(None).cast("double").alias("value"),
        F.col("mode").alias("value_str"))
    return med.unionByName(modes)


def _stored(p: Params, feature, cohort, stat):
    """(exists, value) -- a stored NULL is different from no statistic."""
    if p.has(STAGE, feature, cohort, stat):
        return True, p.value(STAGE, feature, cohort, stat)
    return False, None


def apply_impute(df: DataFrame, params: DataFrame | Params, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """E6-E10 in one projection.

    * E6  student with no profession -> 'Student'
    * E7  anomalous NULL in a cohort column -> that cohort's median; the global
          median and then 0.0 are used only when no statistic was stored
    * E8  professional with no profession -> professionals' mode
    * E9  other numeric NULL -> training median (0.0 when none stored)
    * E10 string NULL (except id/name/profession) -> training mode
    Structural NULLs (E5) are left as they are.
    """
    p = params if isinstance(params, Params) else Params.collect(params, STAGE)
    if not p:
        raise ValueError("apply_impute: no fitted statistics (fit_impute on the training rows first)")
    df = clean_doubles(df)
    is_s = F.col(cols.cohort) == cols.student
    is_p = F.col(cols.cohort) == cols.professional
    cohort_cols = {c: (is_s, cols.student) for c in cols.student_only}
    cohort_cols.update({c: (is_p, cols.professional) for c in cols.professional_only})
    numeric = set(numeric_columns(df, exclude=(cols.id, cols.label)))
    strings = set(string_columns(df, exclude=(cols.id, cols.name, cols.profession)))
    out = []
    for c in df.columns:
        col = F.col(c)
        if c == cols.profession:
            key = (STAGE, c, cols.professional, "mode")
            fill_p = p.value_str(*key) if p.has(*key) else UNKNOWN
            e = (F.when(col.isNull() & is_s, F.lit(cols.student))
                  .when(col.isNull() & is_p, F.lit(fill_p))
                  .otherwise(col))
        elif c in cohort_cols:
            cond, who = cohort_cols[c]
            ok, v = _stored(p, c, who, "median")
            if not ok:
                ok, v = _stored(p, c, ALL, "median")
                v = v if ok else 0.0
            e = F.when(col.isNull() & F.coalesce(cond, F.lit(False)), F.lit(v).cast("double")).otherwise(col)
        elif c in numeric:
            ok, v = _stored(p, c, ALL, "median")
            e = F.coalesce(col.cast("double"), F.lit(v if ok else 0.0).cast("double"))
        elif c in strings:
            if p.has(STAGE, c, ALL, "mode"):
                v = p.value_str(STAGE, c, ALL, "mode")
            else:
                v = UNKNOWN
            e = F.coalesce(col, F.lit(v))
        else:
            e = col
        out.append(e.alias(c))
    return df.select(out)


def structural_report(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """E5: structural NULLs per cohort and column (kept, only counted)."""
    is_s = F.col(cols.cohort) == cols.student
    is_p = F.col(cols.cohort) == cols.professional
    items = [(cols.student, c, is_s) for c in present(df, cols.professional_only + (cols.profession,))]
    items += [(cols.professional, c, is_p) for c in present(df, cols.student_only)]
    aggs = [F.count_if(F.coalesce(cond, F.lit(False)) & F.col(c).isNull()).alias(f"{i}")
            for i, (_, c, cond) in enumerate(items)]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(who).alias("cohort"), F.lit(c).alias("feature"),
                 F.col(f"{i}").cast("long").alias("n_structural"))
        for i, (who, c, _) in enumerate(items)])))


def impute_zero_structural(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """E11 (older variant): structural NULLs become 0.0 -- professional-only
    columns for students, student-only columns for professionals."""
    is_s = F.coalesce(F.col(cols.cohort) == cols.student, F.lit(False))
    is_p = F.coalesce(F.col(cols.cohort) == cols.professional, F.lit(False))
    so, po = set(cols.student_only), set(cols.professional_only)
    out = []
    for c in df.columns:
        col = F.col(c)
        if c in po:
            e = F.when(is_s & col.isNull(), F.lit(0.0)).otherwise(col)
        elif c in so:
            e = F.when(is_p & col.isNull(), F.lit(0.0)).otherwise(col)
        else:
            e = col
        out.append(e.alias(c))
    return df.select(out)


# --------------------------------------------------------------------------
# IQR clipping

CLIP_STAGE = "clip"
# Valid range of each clipped column (lower, upper).
CLIP_LIMITS = {"hours": (0.0, 24.0), "cgpa": (0.0, 10.0)}
CLIP_IQR_FACTOR = 3.0


def fit_clip(df: DataFrame, limits: dict | None = None, factor: float = CLIP_IQR_FACTOR,
             approx: bool = False) -> DataFrame:
    """Bounds Q1 - f*IQR, Q3 + f*IQR per column, tightened to the column's
    valid range.  Quartiles are exact and interpolate linearly."""
    limits = CLIP_LIMITS if limits is None else limits
    cs = present(df, list(limits))
    if not cs:
        return empty_params(df.sparkSession)
    quartiles = [0.25, 0.75]
    if approx:
        qs = df.agg(*[F.percentile_approx(nan_to_null(F.col(c)), quartiles, 10000).alias(c) for c in cs])
    else:
        qs = quantile_frame(df, {c: (nan_to_null(F.col(c)), quartiles) for c in cs})
    bounds = []
    for c in cs:
        q1, q3 = F.col(c)[0].cast("double"), F.col(c)[1].cast("double")
        iqr = q3 - q1
        lo_lim, hi_lim = limits[c]
        lo = q1 - F.lit(factor) * iqr
        hi = q3 + F.lit(factor) * iqr
        if lo_lim is not None:
            lo = F.when(lo.isNotNull(), F.greatest(lo, F.lit(float(lo_lim))))
        if hi_lim is not None:
            hi = F.when(hi.isNotNull(), F.least(hi, F.lit(float(hi_lim))))
        bounds += [lo.alias(f"{c}__lo"), hi.alias(f"{c}__hi")]
    specs = [(f"{c}__{s}", c, ALL, s, False) for c in cs for s in ("lo", "hi")]
    return long_params(qs.select(*bounds), CLIP_STAGE, specs)


def apply_clip(df: DataFrame, params: DataFrame | Params) -> DataFrame:
    """Clip (not drop) to the fitted bounds; NULL stays NULL, a NULL bound
    does not clip."""
    p = params if isinstance(params, Params) else Params.collect(params, CLIP_STAGE)
    out = []
    for c in df.columns:
        col = F.col(c)
        if p.has(CLIP_STAGE, c, ALL, "lo"):
            lo = p.value(CLIP_STAGE, c, ALL, "lo")
            hi = p.value(CLIP_STAGE, c, ALL, "hi")
            e = col
            if hi is not None:
                e = F.when(e > hi, F.lit(hi)).otherwise(e)
            if lo is not None:
                e = F.when(e < lo, F.lit(lo)).otherwise(e)
            out.append(e.cast("double").alias(c))  # a bound need not be a whole number
        else:
            out.append(col)
    return df.select(out)


def clip_counts(df: DataFrame, params: DataFrame | Params) -> DataFrame:
    """Rows outside the bounds per clipped column (the reference's report)."""
    p = params if isinstance(params, Params) else Params.collect(params, CLIP_STAGE)
    feats = sorted({k[1] for k, _ in p.items(CLIP_STAGE)})
    aggs = []
    for c in feats:
        lo, hi = p.value(CLIP_STAGE, c, ALL, "lo"), p.value(CLIP_STAGE, c, ALL, "hi")
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < lo)
        if hi is not None:
            cond = cond | (F.col(c) > hi)
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).cast("long").alias(c))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_clipped"))
                                         for c in feats])))


# --------------------------------------------------------------------------
# inf/NaN fill after feature construction, model-specific fill

FILL_STAGE = "fill"


def fit_fill(df: DataFrame, exclude=(), approx: bool = False) -> DataFrame:
    """E14 fit: training median of every numeric column that has a NULL (or
    NaN/inf) in the training rows.  Two single-pass jobs: NULL counts, then
    medians of only the columns that need one."""
    feats = numeric_columns(df, exclude=exclude)
    clean = df.select([nan_to_null(F.col(c).cast("double")).alias(c) for c in feats])
    if not feats:
        return empty_params(df.sparkSession)
    nulls = clean.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in feats]).first()
    need = [c for c in feats if nulls[c] > 0]
    if not need:
        return empty_params(df.sparkSession)
    one = _medians(clean, {c: F.col(c) for c in need}, approx)
    return long_params(one, FILL_STAGE, [(c, c, ALL, "median", False) for c in need])


def apply_fill(df: DataFrame, params: DataFrame | Params, exclude=(), indicators: bool = False,
               suffix: str = "__missing") -> DataFrame:
    """E14 apply: inf -> NULL; NULL -> stored training median; a column with
    no stored statistic gets 0.0; a stored NULL (all-NULL training column)
    leaves the value NULL.  ``indicators`` adds ``<col>__missing`` 0/1
    columns (H8), computed before the fill."""
    p = params if isinstance(params, Params) else Params.collect(params, FILL_STAGE)
    feats = set(numeric_columns(df, exclude=exclude))
    out, ind = [], []
    for c in df.columns:
        if c not in feats:
            out.append(F.col(c))
            continue
        x = nan_to_null(F.col(c).cast("double"))
        if p.has(FILL_STAGE, c, ALL, "median"):
            v = p.value(FILL_STAGE, c, ALL, "median")
            e = F.coalesce(x, F.lit(v).cast("double"))
        else:
            e = F.coalesce(x, F.lit(0.0))
        out.append(e.alias(c))
        if indicators:
            ind.append(x.isNull().cast("int").alias(c + suffix))
    return df.select(out + ind)


def fill_for_model(df: DataFrame, params: DataFrame | Params, exclude=()) -> DataFrame:
    """E15 + H8: models that reject NULL get the training-median fill plus a
    missing-indicator column per feature (the re-aim of native NaN
    handling in tree boosters)."""
    return apply_fill(df, params, exclude=exclude, indicators=True)
