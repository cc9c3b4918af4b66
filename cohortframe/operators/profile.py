"""Profiling.

Rule used throughout: aggregate first, unpivot the (one-row or few-row)
result.  Every profile is one aggregation job over the data; wide unpivots
of the data itself are used only where a map-side partial aggregation
immediately collapses them (value counts, histograms).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortframe.functions.columns import nan_to_null, numeric_columns, present, string_columns
from cohortframe.operators.quantiles import exact_quantiles, literals, quantile_frame
from cohortframe.schema import DEFAULT_COLUMNS, Columns


def _long(one: DataFrame, keys: list[str], rows: list[tuple[tuple, dict]]) -> DataFrame:
    """Build long rows from one aggregated row: each entry is
    (key literals, {out name: agg column})."""
    structs = []
    for key_vals, agg_cols in rows:
        parts = [F.lit(v).alias(k) for k, v in zip(keys, key_vals)]
        parts += [F.col(a).alias(o) for o, a in agg_cols.items()]
        structs.append(F.struct(*parts))
    return one.select(F.inline(F.array(*structs)))


def column_profile(df: DataFrame) -> DataFrame:
    """B1: position, type and non-NULL count of every column."""
    one = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [((i, c, df.schema[c].dataType.simpleString()), {"non_null": f"_{i}"})
            for i, c in enumerate(df.columns)]
    return _long(one, ["position", "column_name", "dtype"], rows)


def head(df: DataFrame, n: int = 10, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """B1: first rows by id (top-k by key, not by file order)."""
    return df.orderBy(cols.id).limit(n)


def describe(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, approx: bool = False) -> DataFrame:
    """B2: count, mean, sample std, min, quartiles, max per numeric column."""
    feats = numeric_columns(df, exclude=(cols.id, cols.label))
    quartiles = [0.25, 0.5, 0.75]
    aggs, wanted = [], {}
    for i, c in enumerate(feats):
        x = nan_to_null(F.col(c).cast("double"))
        wanted[f"q{i}"] = (x, quartiles)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    if approx:
        one = df.agg(*aggs, *[F.percentile_approx(x, p, 10000).alias(a) for a, (x, p) in wanted.items()])
    else:
        one = df.agg(*aggs).withColumns(literals(exact_quantiles(df, wanted)[()]))
    one = one.select("*", *[F.col(f"q{i}")[j].alias(f"q{i}_{j}") for i in range(len(feats)) for j in range(3)])
    rows = [((c,), {"count": f"n{i}", "mean": f"m{i}", "std": f"s{i}", "min": f"lo{i}",
                    "p25": f"q{i}_0", "p50": f"q{i}_1", "p75": f"q{i}_2", "max": f"hi{i}"})
            for i, c in enumerate(feats)]
    return _long(one, ["feature"], rows)


def class_balance(df: DataFrame, label: str = "label", ratio_flag: float = 1.5) -> DataFrame:
    """Count and percent per class, imbalance ratio max/min, flag when
    the ratio exceeds ``ratio_flag``.  The window runs over the grouped
    result (one row per class)."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    ratio = F.max("n").over(w) / F.min("n").over(w)
    return g.select(label, "n", (F.col("n") * 100.0 / F.sum("n").over(w)).alias("pct"),
                    ratio.alias("imbalance_ratio"), (ratio > ratio_flag).alias("imbalanced"))


def _null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull() | (F.isnan(F.col(c)) if c in _floats(df) else F.lit(False)))
                    .alias(f"_{i}") for i, c in enumerate(columns)])


def _floats(df):
    return {f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}


def missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and percent per column, only columns with a
    missing value, largest first."""
    columns = df.columns if columns is None else present(df, columns)
    one = _null_counts(df, columns)
    rows = [((c,), {"missing_count": f"_{i}", "_rows": "_rows"}) for i, c in enumerate(columns)]
    long = _long(one, ["feature"], rows)
    return (long.filter(F.col("missing_count") > 0)
                .select("feature", F.col("missing_count").cast("long").alias("missing_count"),
                        (F.col("missing_count") * 100.0 / F.col("_rows")).alias("missing_pct"))
                .orderBy(F.desc("missing_count"), "feature"))


def missing_core(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """B4 restricted to the columns every row is expected to carry."""
    return missing(df, list(cols.core))


def missing_by_cohort(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """NULL count per cohort and column, labelled structural (the other
    cohort's columns) or anomalous."""
    feats = [c for c in df.columns if c not in (cols.id, cols.cohort)]
    g = df.groupBy(cols.cohort).agg(F.count(F.lit(1)).alias("_rows"),
                                    *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(feats)])
    long = g.select(cols.cohort, "_rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("n_missing")) for i, c in enumerate(feats)])))
    structural_s = list(cols.professional_only) + [cols.profession]
    structural_p = list(cols.student_only)
    kind = (F.when((F.col(cols.cohort) == cols.student) & F.col("feature").isin(structural_s), "structural")
             .when((F.col(cols.cohort) == cols.professional) & F.col("feature").isin(structural_p), "structural")
             .otherwise("anomalous"))
    return (long.filter(F.col("n_missing") > 0)
                .select(cols.cohort, "feature", F.col("n_missing").cast("long").alias("n_missing"),
                        (F.col("n_missing") * 100.0 / F.col("_rows")).alias("pct_of_cohort"),
                        kind.alias("kind")))


def value_counts(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Frequency of every value of every string column except id, name
    and target (NULL not counted)."""
    feats = string_columns(df, exclude=(cols.id, cols.name, cols.label))
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"))
                                           for c in feats])))
    return (stacked.filter(F.col("value").isNotNull())
                   .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def correlation(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Pairwise-complete Pearson correlation of every numeric pair (id
    excluded, target included), one aggregation."""
    feats = numeric_columns(df, exclude=(cols.id,))
    upper = [(a, b) for i, a in enumerate(feats) for b in feats[i:]]
    return _pairs_corr(df, upper, mirror=True)


# A variance below this part of the mean square is a constant column's rounding.
NO_SPREAD = 1e-12


def _pairs_corr(df: DataFrame, pairs: list[tuple[str, str]], mirror: bool = False) -> DataFrame:
    """Pearson correlation of many column pairs from one Gram matrix.

    With every column shifted by its mean, the matrix product of the blocks
    (1 where known, x, x * x) holds all counts and sums of every pair complete
    in a row.  Each task sends one such small matrix, however many rows it
    read; rows are neither stacked nor shuffled."""
    feats = list(dict.fromkeys(c for pair in pairs for c in pair))
    val = {c: nan_to_null(F.col(c).cast("double")) for c in feats}
    mean = df.agg(*[F.avg(val[c]).alias(c) for c in feats]).first().asDict()
    wide = df.select(*[(val[c] - F.lit(float(mean[c] or 0.0))).alias(f"x{i}") for i, c in enumerate(feats)])
    k = len(feats)

    def gram(batches):
        total = np.zeros((3 * k, 3 * k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            z = np.concatenate([known, x, x * x], axis=1)
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "v"])

    cells = wide.mapInArrow(gram, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()  # (3 k)^2 rows
    g = np.zeros(9 * k * k)
    for r in cells:
        g[r["cell"]] = r["v"]
    g = g.reshape(3 * k, 3 * k)
    at = {c: i for i, c in enumerate(feats)}
    rows = []
    for a, b in pairs:
        x, y = at[a], at[b]
        n, sx, sy, sxy, sxx, syy = (float(v) for v in (g[x, y], g[k + x, y], g[x, k + y], g[k + x, k + y], g[2 * k + x, y], g[x, 2 * k + y]))
        corr = None
        if n:
            vx, vy = sxx - sx * sx / n, syy - sy * sy / n
            if vx > NO_SPREAD * sxx and vy > NO_SPREAD * syy:
                corr = (sxy - sx * sy / n) / math.sqrt(vx * vy)
        rows.append((a, b, corr))
    res = df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")
    if mirror:
        res = res.unionByName(res.filter(F.col("feature_a") != F.col("feature_b"))
                              .select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"),
                                      "corr"))
    return res


def target_correlation(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Correlation of each numeric column with the target, sorted."""
    feats = numeric_columns(df, exclude=(cols.id,))
    res = _pairs_corr(df, [(c, cols.label) for c in feats])
    return res.select(F.col("feature_a").alias("feature"), "corr").orderBy(F.desc("corr"))


def stats_by_target(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, approx: bool = False) -> DataFrame:
    """Mean, median and sample std of each profile column per class;
    grouped aggregations, then the few result rows are unpivoted."""
    feats = present(df, cols.numeric_profile)
    x = {i: nan_to_null(F.col(c).cast("double")) for i, c in enumerate(feats)}
    aggs = [a for i in x for a in (F.avg(x[i]).alias(f"m{i}"), F.stddev(x[i]).alias(f"s{i}"))]
    if approx:
        g = df.groupBy(cols.label).agg(*aggs, *[F.percentile_approx(x[i], 0.5, 10000).alias(f"d{i}") for i in x])
    else:
        med = quantile_frame(df, {f"d{i}": (x[i], [0.5]) for i in x}, [cols.label])
        med = med.select(F.col(cols.label).alias("_class"), *[F.col(f"d{i}")[0].alias(f"d{i}") for i in x])
        g = df.groupBy(cols.label).agg(*aggs).join(F.broadcast(med), F.col(cols.label).eqNullSafe(F.col("_class")))  # one row per class
    return g.select(cols.label, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"d{i}").alias("median"),
                 F.col(f"s{i}").alias("std")) for i, c in enumerate(feats)])))


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 30,
              cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Equal-width bins from min to max (last bin closed), NULL
    dropped, empty bins with n = 0.  Min/max are fitted scalars; the binning
    pass is one partial aggregation."""
    feats = present(df, cols.numeric_profile) if columns is None else present(df, columns)
    mm = df.agg(*[F.min(nan_to_null(F.col(c).cast("double"))).alias(f"lo{i}") for i, c in enumerate(feats)],
                *[F.max(nan_to_null(F.col(c).cast("double"))).alias(f"hi{i}") for i, c in enumerate(feats)]).first()
    structs, every = [], []
    for i, c in enumerate(feats):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            continue
        x = nan_to_null(F.col(c).cast("double"))
        if hi > lo:
            w = (hi - lo) / bins
            b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
        else:
            w = 0.0
            b = F.lit(0)
        structs.append(F.struct(F.lit(c).alias("feature"), F.when(x.isNotNull(), b).alias("bin")))
        every += [(c, k, float(lo), float(w)) for k in range(bins if hi > lo else 1)]
    grid = df.sparkSession.createDataFrame(every, "feature string, bin int, lo double, width double")
    if not structs:
        return grid.select("feature", "bin", F.col("lo").alias("bin_lo"), F.col("lo").alias("bin_hi"), F.lit(0).cast("long").alias("n"))
    stacked = df.select(F.inline(F.array(*structs))).filter(F.col("bin").isNotNull())
    counted = stacked.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    g = grid.join(counted, ["feature", "bin"], "left").na.fill(0, ["n"])
    return g.select("feature", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_hi"), "n")


def box_stats(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, whisker: float = 1.5) -> DataFrame:
    """Quartiles per class and column, whiskers at the most extreme
    point within ``whisker`` x IQR, outlier count.  Pass 1: quartiles per
    class (small result, broadcast back); pass 2: conditional min/max/count."""
    feats = present(df, cols.numeric_profile)
    q = quantile_frame(df, {f"q{i}": (nan_to_null(F.col(c).cast("double")), [0.25, 0.5, 0.75]) for i, c in enumerate(feats)}, [cols.label])
    j = df.join(F.broadcast(q), cols.label)  # one row per class
    aggs = []
    for i, c in enumerate(feats):
        x = nan_to_null(F.col(c).cast("double"))
        q1, q3 = F.col(f"q{i}")[0], F.col(f"q{i}")[2]
        lo_f = q1 - whisker * (q3 - q1)
        hi_f = q3 + whisker * (q3 - q1)
        aggs += [F.first(F.col(f"q{i}")).alias(f"q{i}"),
                 F.min(F.when(x >= lo_f, x)).alias(f"wl{i}"), F.max(F.when(x <= hi_f, x)).alias(f"wh{i}"),
                 F.count_if((x < lo_f) | (x > hi_f)).cast("long").alias(f"o{i}")]
    g = j.groupBy(cols.label).agg(*aggs)
    return g.select(cols.label, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"q{i}")[0].alias("q1"), F.col(f"q{i}")[1].alias("median"),
                 F.col(f"q{i}")[2].alias("q3"), F.col(f"wl{i}").alias("whisker_lo"),
                 F.col(f"wh{i}").alias("whisker_hi"), F.col(f"o{i}").alias("n_outliers"))
        for i, c in enumerate(feats)])))


def _mv(name, value):
    return F.struct(F.lit(name).alias("metric"), value.alias("value"))


def summary(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """One long (metric, value) table -- rows, feature counts by type,
    total missing cells, columns with missing values, class counts and
    imbalance ratio.  Two jobs: null counts and class counts."""
    n_str = len(string_columns(df))
    n_num = len(numeric_columns(df))
    one = _null_counts(df, df.columns)
    nulls = F.lit(0)
    with_missing = F.lit(0)
    for i in range(len(df.columns)):
        nulls = nulls + F.col(f"_{i}")
        with_missing = with_missing + (F.col(f"_{i}") > 0).cast("int")
    base = one.select(F.inline(F.array(
        F.struct(F.lit("rows").alias("metric"), F.col("_rows").cast("double").alias("value")),
        _mv("total_features", F.lit(float(len(df.columns) - 2))),
        _mv("categorical_features", F.lit(float(n_str - 2))),
        _mv("numerical_features", F.lit(float(n_num - 2))),
        _mv("total_missing", nulls.cast("double")),
        _mv("columns_with_missing", with_missing.cast("double")))))
    bal = class_balance(df, cols.label)
    cls = bal.select(F.concat(F.lit("class_"), F.col(cols.label).cast("string")).alias("metric"),
                     F.col("n").cast("double").alias("value"))
    ratio = bal.agg((F.max("n") / F.min("n")).alias("value")).select(F.lit("imbalance_ratio").alias("metric"), "value")
    return base.unionByName(cls).unionByName(ratio)


def cohort_rates(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows, share and target rate per cohort."""
    g = df.groupBy(cols.cohort).agg(F.count(F.lit(1)).alias("n"),
                                    F.avg(F.col(cols.label).cast("double")).alias("target_rate"))
    return g.select(cols.cohort, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"),
                    "target_rate")
