"""Encoding (F1-F6).

* F1 ordinal maps (literal ``create_map`` lookups).
* F2 label encoding: sorted distinct values -> 0..n-1, NULL -> 'Unknown'
  (profession) or 'nan' (other columns) first, unseen -> the index of
  'Unknown' when it was a training class, else n.
* F3/F4 smoothed target encoding and its application.
* F5 one-pass out-of-fold target encoding (no loop over folds).
* F6 method selection with the documented fallbacks.

Dictionaries are parameter tables.  Small ones are applied as literal maps;
large ones by a join that is broadcast only under a checked row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortframe.functions.columns import string_columns
from cohortframe.operators.rank import distributed_row_number
from cohortframe.params import ALL
from cohortframe.session import cut_lineage
from cohortframe.schema import DEFAULT_COLUMNS, Columns

# Ordinal scores of sleep duration and dietary habits.
SLEEP_MAP = {
    "Less than 5 hours": 1,
    "5-6 hours": 2,
    "6-7 hours": 4,
    "7-8 hours": 5,
    "More than 8 hours": 2,
}
DIET_MAP = {
    "Healthy": 0,
    "Moderate": 1,
    "Unhealthy": 3,
}
UNKNOWN = "Unknown"
NAN_TOKEN = "nan"
SMOOTHING = 10.0
DEFAULT_GLOBAL = 0.5

LABEL_STAGE = "label"
TARGET_STAGE = "target"
# Dictionaries of few entries become literals in the plan (a lookup walks them); others are joined.
LITERAL_MAP_LIMIT = 256
# Tables up to this many bytes are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20
# Bounds between the buckets of a label dictionary come from this many hashed draws of its values.
BOUND_SAMPLE, BUCKETS = 8192, 64


def _lookup(mapping: dict):
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])


def encode_ordinal(df: DataFrame, maps: dict | None = None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """F1: ordinal scores; values outside the map become NULL."""
    maps = {cols.sleep: SLEEP_MAP, cols.diet: DIET_MAP} if maps is None else maps
    return df.select([_lookup(maps[c])[F.col(c)].cast("double").alias(c) if c in maps else F.col(c)
                      for c in df.columns])


def label_columns(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> list[str]:
    """Columns label-encoded by default: every string column except id,
    target and the ordinal ones (profession included)."""
    return string_columns(df, exclude=(cols.id, cols.label, cols.sleep, cols.diet))


def _filled(c: str, cols: Columns):
    tok = UNKNOWN if c == cols.profession else NAN_TOKEN
    return F.coalesce(F.col(c).cast("string"), F.lit(tok))


def fit_label(df: DataFrame, columns: list[str] | None = None,
              cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """F2 fit: dictionary ``(feature, category) -> index`` in ascending
    category order.  The index is a distributed dense rank over buckets
    between sampled quantiles of the category text, so a long dictionary is
    not sorted in one task, however its values begin."""
    columns = label_columns(df, cols) if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], "stage string, feature string, cohort string, stat string, value double, value_str string")
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), _filled(c, cols).alias("value_str")) for c in columns])))
    distinct = stacked.groupBy("feature", "value_str").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    distinct = cut_lineage(distinct)
    distinct = distinct.withColumn("_b", _text_bucket(distinct))
    ranked = distributed_row_number(distinct, ["feature"], "_b", [F.col("value_str")], out="_rn")
    return ranked.select(F.lit(LABEL_STAGE).alias("stage"), "feature", F.lit(ALL).alias("cohort"),
                         F.lit("index").alias("stat"), (F.col("_rn") - 1).cast("double").alias("value"),
                         "value_str")


def _text_bucket(distinct: DataFrame):
    """Bucket of ``value_str`` within its feature, rising with the text: the
    number of sampled quantiles that are not above it."""
    drawn = distinct.orderBy(F.xxhash64("feature", "value_str")).limit(BOUND_SAMPLE).collect()
    if len(drawn) < BOUND_SAMPLE:  # the whole dictionary is short
        return F.lit(0)
    of = {}
    for r in drawn:
        of.setdefault(r["feature"], []).append(r["value_str"])
    bucket = F.lit(0)
    for f, values in sorted(of.items()):
        values.sort()
        bounds = sorted({values[i * len(values) // BUCKETS] for i in range(1, BUCKETS)})
        below = F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x <= F.col("value_str")))
        bucket = F.when(F.col("feature") == f, below).otherwise(bucket)
    return bucket


def _join_small(df: DataFrame, small: DataFrame, on, how="left") -> DataFrame:
    """Left join with a table that is broadcast when its counted bytes allow it."""
    small = cut_lineage(small)
    text = [c for c, t in small.dtypes if t == "string"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(16 * len(small.columns) + 16))
    size = small.agg(F.sum(width)).first()[0] or 0
    return df.join(F.broadcast(small) if size <= BROADCAST_BYTES else small, on=on, how=how)


def apply_label(df: DataFrame, dictionary: DataFrame, columns: list[str] | None = None,
                cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """F2 apply: NULL -> token, unseen -> 'Unknown' index or n; a column
    without a fitted dictionary becomes 0."""
    columns = label_columns(df, cols) if columns is None else columns
    dic = dictionary.filter(F.col("stage") == LABEL_STAGE).select("feature", "value_str", "value")
    sizes = {r["feature"]: r["n"] for r in dic.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    literal, joined = {}, []
    for c in columns:
        n = sizes.get(c, 0)
        if n == 0:
            continue
        if n <= LITERAL_MAP_LIMIT:
            literal[c] = n
        else:
            joined.append(c)
    lit_maps = {}
    if literal:
        rows = dic.filter(F.col("feature").isin(list(literal))).collect()
        for r in rows:
            lit_maps.setdefault(r["feature"], {})[r["value_str"]] = int(r["value"])
    sel = []
    for c in df.columns:
        if c not in columns:
            sel.append(F.col(c))
        elif c in lit_maps:
            m = lit_maps[c]
            unseen = m.get(UNKNOWN, len(m))
            sel.append(F.coalesce(_lookup(m)[_filled(c, cols)], F.lit(unseen)).cast("int").alias(c))
        elif c in joined:
            sel.append(F.col(c))
        else:
            sel.append(F.lit(0).alias(c))
    out = df.select(sel)
    for c in joined:
        d = dic.filter(F.col("feature") == c)
        unk = d.filter(F.col("value_str") == UNKNOWN).select("value").collect()
        unseen = int(unk[0][0]) if unk else sizes[c]
        d = d.select(F.col("value_str").alias(f"_{c}_k"), F.col("value").cast("int").alias(f"_{c}_v"))
        out = _join_small(out.withColumn(f"_{c}_k", _filled(c, cols)), d, f"_{c}_k")
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}_v"), F.lit(unseen))).drop(f"_{c}_k", f"_{c}_v")
    return out.select(df.columns)


# ------------------------------------------------------------------- target

def fit_target(df: DataFrame, column: str, label: str = "label",
               smoothing: float = SMOOTHING) -> DataFrame:
    """(mean*n + global*m) / (n + m) per category (NULL category not
    encoded), plus the global mean."""
    g = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    per = (df.filter(F.col(column).isNotNull())
             .groupBy(F.col(column).cast("string").alias("value_str"))
             .agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")))
    enc = per.select(F.lit(TARGET_STAGE).alias("stage"), F.lit(column).alias("feature"),
                     F.lit(ALL).alias("cohort"), F.lit("mean").alias("stat"),
                     ((F.col("_s") + F.lit(g) * smoothing) / (F.col("_n") + smoothing)).alias("value"),
                     "value_str")
    glob = df.sparkSession.createDataFrame(
        [(TARGET_STAGE, column, ALL, "global", g, None)], enc.schema)
    return enc.unionByName(glob)


def apply_target(df: DataFrame, encoding: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """lookup; unseen or NULL -> stored global mean (0.5 if absent); no
    stored map at all -> 0."""
    out = out or column
    enc = encoding.filter((F.col("stage") == TARGET_STAGE) & (F.col("feature") == column))
    glob = enc.filter(F.col("stat") == "global").select("value").collect()
    n = enc.filter(F.col("stat") == "mean").count()
    if not glob and n == 0:
        return df.withColumn(out, F.lit(0.0))
    g = glob[0][0] if glob and glob[0][0] is not None else DEFAULT_GLOBAL
    m = enc.filter(F.col("stat") == "mean").select(F.col("value_str").alias("_k"), F.col("value").alias("_v"))
    keyed = df.withColumn("_k", F.col(column).cast("string"))
    j = _join_small(keyed, m, "_k")
    res = j.withColumn(out, F.coalesce(F.col("_v"), F.lit(g))).drop("_k", "_v")
    cols_out = df.columns if out in df.columns else df.columns + [out]
    return res.select(cols_out)


def target_oof(df: DataFrame, column: str, label: str = "label", fold_col: str = "fold",
               smoothing: float = SMOOTHING, out: str | None = None) -> DataFrame:
    """each row encoded from the *other* folds in one pass.

    Per (fold, category) sums and counts; the other-fold statistic is the
    category total minus the row's own fold.  A category absent from the
    other folds (or NULL) gets the global mean of all rows.
    """
    out = out or column
    g = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    per = (df.filter(F.col(column).isNotNull())
             .groupBy(fold_col, F.col(column).alias("_k"))
             .agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy("_k")
    other = per.select(fold_col, "_k",
                       (F.sum("_s").over(w) - F.col("_s")).alias("_os"),
                       (F.sum("_n").over(w) - F.col("_n")).alias("_on"))
    enc = other.select(fold_col, "_k",
                       F.when(F.col("_on") > 0, (F.col("_os") + F.lit(g) * smoothing) /
                              (F.col("_on") + smoothing)).alias("_v"))
    # one row per (fold, category): bounded by folds x categories; broadcast
    # under a checked size so a hot category never funnels into one reducer
    j = _join_small(df.withColumn("_k", F.col(column)), enc, [fold_col, "_k"])
    res = j.withColumn(out, F.coalesce(F.col("_v"), F.lit(g))).drop("_k", "_v")
    cols_out = df.columns if out in df.columns else df.columns + [out]
    return res.select(cols_out)


def encode(df: DataFrame, fitted: DataFrame | None, method: str = "label", fit: bool = True,
           label: str = "label", cols: Columns = DEFAULT_COLUMNS):
    """encoder selection.  Returns (encoded frame, parameter table).

    * ordinal maps always (F1);
    * profession by ``method``: 'target' needs the label when fitting and
      falls back to label encoding without it; applying 'target' without a
      stored map gives 0;
    * every other string column is label encoded.
    """
    if method not in ("label", "target"):
        raise ValueError(f"unknown encoding method: {method}")
    df = encode_ordinal(df, cols=cols)
    lab_cols = label_columns(df, cols)
    prof = cols.profession if cols.profession in df.columns else None
    use_target = method == "target" and prof is not None
    if use_target and fit and label not in df.columns:
        use_target = False
    if use_target:
        lab_cols = [c for c in lab_cols if c != prof]
    if fit:
        params = fit_label(df, lab_cols, cols)
        if use_target:
            params = params.unionByName(fit_target(df, prof, label))
    else:
        params = fitted
    out = apply_label(df, params, lab_cols, cols)
    if use_target:
        out = apply_target(out, params, prof)
    return out, params


def label_index_map(params: DataFrame, feature: str) -> dict:
    """Driver-side view of one small dictionary (for reports and tests)."""
    rows = (params.filter((F.col("stage") == LABEL_STAGE) & (F.col("feature") == feature))
                  .select("value_str", "value").collect())
    return {r[0]: int(r[1]) for r in rows}
