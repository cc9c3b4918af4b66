"""Scaling and missing indicators (H1-H3, H8).

* H1 standard: (x - mean) / population std (zero spread -> divide by 1).
* H2 robust: (x - median) / IQR with interpolated quartiles (IQR 0 -> 1).
* H3 'none' is the identity; an unknown method raises; applying without a
  fit returns the input unchanged.
* H8 ``<col>__missing`` 0/1 columns next to the values.

Fit = one aggregation over the training rows; apply = one projection.
NULLs are ignored by the fit and stay NULL.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortframe.functions.columns import nan_to_null, numeric_columns, present
from cohortframe.operators.quantiles import quantile_frame
from cohortframe.params import ALL, Params, empty_params, long_params

STAGE = "scale"
METHODS = ("standard", "robust", "none")


def fit_scale(df: DataFrame, features: list[str] | None = None, method: str = "standard",
              exclude=("id", "label"), approx: bool = False) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    feats = numeric_columns(df, exclude=exclude) if features is None else present(df, features)
    if method == "none" or not feats:
        return empty_params(df.sparkSession)
    quartiles = [0.25, 0.5, 0.75]
    x = {c: nan_to_null(F.col(c).cast("double")) for c in feats}
    if method == "standard":
        one = df.agg(*[F.struct(F.avg(x[c]).alias("c"), F.stddev_pop(x[c]).alias("s")).alias(f"p{i}") for i, c in enumerate(feats)])
    else:
        q = (df.agg(*[F.percentile_approx(x[c], quartiles, 10000).alias(f"q{i}") for i, c in enumerate(feats)]) if approx
             else quantile_frame(df, {f"q{i}": (x[c], quartiles) for i, c in enumerate(feats)}))
        one = q.select(*[F.struct(F.col(f"q{i}")[1].alias("c"), (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]).alias("s")).alias(f"p{i}") for i in range(len(feats))])
    aggs, specs = [], []
    for i, c in enumerate(feats):
        center, spread = F.col(f"p{i}.c"), F.col(f"p{i}.s")
        aggs += [center.cast("double").alias(f"c{i}"),
                 F.when(spread == 0, F.lit(1.0)).otherwise(spread).cast("double").alias(f"s{i}")]
        specs += [(f"c{i}", c, ALL, "center", False), (f"s{i}", c, ALL, "scale", False)]
    return long_params(one.select(*aggs), STAGE, specs)


def apply_scale(df: DataFrame, params: DataFrame | Params | None, method: str = "standard") -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    if method == "none":
        return df
    p = None if params is None else (params if isinstance(params, Params) else Params.collect(params, STAGE))
    if not p:
        warnings.warn("apply_scale: no fitted scaler, returning the input unchanged")
        return df
    out = []
    for c in df.columns:
        if p.has(STAGE, c, ALL, "center"):
            m, s = p.value(STAGE, c, ALL, "center"), p.value(STAGE, c, ALL, "scale")
            x = nan_to_null(F.col(c).cast("double"))
            if m is None or s is None:
                out.append(x.alias(c))
            else:
                out.append(((x - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(out)


def missing_indicators(df: DataFrame, features: list[str] | None = None, exclude=("id", "label"),
                       suffix: str = "__missing") -> DataFrame:
    """H8: 0/1 NULL indicator per feature, appended."""
    feats = numeric_columns(df, exclude=exclude) if features is None else present(df, features)
    return df.select("*", *[nan_to_null(F.col(c).cast("double")).isNull().cast("int").alias(c + suffix)
                            for c in feats])
