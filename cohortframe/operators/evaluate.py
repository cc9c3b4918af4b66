"""Evaluation.

Inputs are long score tables ``(by..., label, score)`` -- one row per scored
row and model -- so every model is evaluated in the same job with ``model``
in the grouping key.  Nothing loops over models or thresholds:

* J1/J2/J4: one aggregation of four conditional counts;
* J3/J5/J6: the distinct-score table with running sums of positives and
  negatives (a distributed prefix sum, ties averaged exactly);
* J11: one pass bins every score to the threshold grid, then suffix sums
  over at most 82 bins per model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortframe.operators.rank import distributed_cumsum, null_safe_join, quantile_bucket
from cohortframe.session import cut_lineage

EPS = 1e-15
# Threshold grid 0.10 .. 0.90 in steps of 0.01 (as integers
# over 100) and the thresholds compared side by side.
GRID_LO, GRID_HI = 10, 90
COMPARE_THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]
DEFAULT_THRESHOLD = 0.5
METRICS = ("f1", "accuracy", "precision", "recall")


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0.0 when b is 0 (zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def predict_at(df: DataFrame, threshold: float | Column, score: str = "score",
               out: str = "prediction") -> DataFrame:
    """Predicted label at a threshold (``score >= threshold``)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn(out, (F.col(score) >= t).cast("int"))


def confusion_counts(df: DataFrame, by=(), label: str = "label", pred: str = "prediction") -> DataFrame:
    """Tn, fp, fn, tp per group (zero cells included)."""
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*by).agg(F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"),
                               F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
                               F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"),
                               F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"))


def confusion_long(counts: DataFrame, by=()) -> DataFrame:
    """J1 as (actual, predicted, n)."""
    return counts.select(*by, F.inline(F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")))))


def with_basic_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and positive-class precision, recall, F1 (0 when
    undefined) from confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select("*", _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                         _div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
                         _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


def basic_metrics(df: DataFrame, by=(), label="label", pred="prediction") -> DataFrame:
    return with_basic_metrics(confusion_counts(df, by, label, pred))


def score_table(df: DataFrame, by=(), label: str = "label", score: str = "score",
                n_buckets: int = 1024) -> DataFrame:
    """Distinct scores per group with positive/negative counts, running
    sums (ascending score) and group totals.  The running sums are a
    distributed prefix sum over equal-count score buckets."""
    by = list(by)
    known = F.col(score).cast("double")
    checked = F.when(known.isNull() | F.isnan(known), F.raise_error(F.lit("a score is NULL or NaN"))).otherwise(known)
    st = df.groupBy(*by, checked.alias("score")).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"),
        F.count_if(F.col(label) != 1).cast("long").alias("neg"))
    # the distinct-score table is read by the bucket bounds, the offsets, the
    # totals and the final window: materialise it once (one scan of the data)
    st = cut_lineage(st)
    st = quantile_bucket(st, "score", n_buckets, out="_b")
    parts = by if by else []
    if not parts:
        st = st.withColumn("_g", F.lit(0))
        parts = ["_g"]
    cum = distributed_cumsum(st, parts, "_b", [F.col("score")], ["pos", "neg"])
    tot = st.groupBy(*parts).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = null_safe_join(cum, F.broadcast(tot), parts)  # one row per group
    return out.drop("_b", *(["_g"] if not by else []))


def auc(df: DataFrame, by=(), label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC with ties averaged (rank-sum form); NULL when a
    group has a single class."""
    st = score_table(df, by, label, score)
    below = F.col("neg_cum") - F.col("neg")
    contrib = F.col("pos") * (below + F.col("neg") / 2.0)
    g = st.groupBy(*by).agg(F.sum(contrib).alias("_s"), F.first("P").alias("P"), F.first("N").alias("N"))
    return g.select(*by, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                F.col("_s") / (F.col("P") * F.col("N"))).alias("auc"))


def roc_points(df: DataFrame, by=(), label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (all points kept)
    and the first point (0, 0), whose threshold is infinite."""
    st = score_table(df, by, label, score)
    tp = F.col("P") - F.col("pos_cum") + F.col("pos")
    fp = F.col("N") - F.col("neg_cum") + F.col("neg")
    pts = st.select(*by, F.col("score").alias("threshold"),
                    F.when(F.col("N") > 0, fp / F.col("N")).alias("fpr"),
                    F.when(F.col("P") > 0, tp / F.col("P")).alias("tpr"))
    start = st.select(*by, "P", "N").distinct().select(
        *by, F.lit(float("inf")).alias("threshold"), F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
        F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"))
    return pts.unionByName(start)


def pr_points(df: DataFrame, by=(), label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the
    final (precision 1, recall 0) point with a NULL threshold."""
    st = score_table(df, by, label, score)
    tp = F.col("P") - F.col("pos_cum") + F.col("pos")
    fp = F.col("N") - F.col("neg_cum") + F.col("neg")
    pts = st.select(*by, F.col("score").alias("threshold"), (tp / (tp + fp)).alias("precision"),
                    F.when(F.col("P") > 0, tp / F.col("P")).alias("recall"))
    end = st.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                           F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def log_loss(df: DataFrame, by=(), label: str = "label", score: str = "score", eps: float = EPS) -> DataFrame:
    """Mean negative log-likelihood with probabilities clipped to
    [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.groupBy(*by).agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def class_report(df: DataFrame, by=(), label="label", pred="prediction") -> DataFrame:
    """Precision / recall / F1 / support per class, accuracy, macro and
    weighted averages (zero_division=0)."""
    c = confusion_counts(df, by, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * p1 * r1, p1 + r1), _div0(2 * p0 * r0, p0 + r0)
    s1, s0 = (tp + fn), (tn + fp)
    n = s1 + s0
    acc = _div0(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))
    return c.select(*by, F.inline(F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, n), _div0(r0 * s0 + r1 * s1, n),
            _div0(f1_0 * s0 + f1_1 * s1, n), n))))


def evaluate_all(df: DataFrame, by=("model",), label="label", score="score",
                 threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Accuracy, precision, recall, F1 at ``threshold``, AUC and
    log-loss for every group, in one plan."""
    by = list(by)
    basic = basic_metrics(predict_at(df, threshold, score), by, label)
    a = auc(df, by, label, score)
    ll = log_loss(df, by, label, score)
    return basic.join(a, by).join(ll, by) if by else basic.crossJoin(a).crossJoin(ll)


def metrics_long(wide: DataFrame, by=("model", "dataset"),
                 metrics=("accuracy", "auc", "f1", "precision", "recall")) -> DataFrame:
    return wide.select(*by, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                        F.col(m).cast("double").alias("value"))
                                               for m in metrics])))


def compare_models(long: DataFrame, datasets=("Train", "Validation")) -> DataFrame:
    """Long (model, dataset, metric, value) -> wide by dataset."""
    return long.groupBy("model", "metric").pivot("dataset", list(datasets)).agg(F.first("value"))


def best_model(wide: DataFrame, dataset: str = "Validation") -> DataFrame:
    """Model with the highest (F1, accuracy) among the given dataset's
    rows; the model name breaks exact ties."""
    v = wide.filter(F.col("dataset") == dataset)
    order = F.struct((-F.col("f1")).alias("a"), (-F.col("accuracy")).alias("b"), F.col("model").alias("c"))
    return v.agg(F.min_by(F.struct("model", "f1", "accuracy"), order).alias("best")).select("best.*")


# ------------------------------------------------------------ threshold sweep

def _grid_bin(score: Column) -> Column:
    """Largest grid index k (10..90) with k/100 <= score; 9 below the grid.
    ``floor(score*100)`` alone can be one off, so the neighbour is checked
    with the comparison itself."""
    k0 = F.floor(score * 100).cast("long")
    k = (F.when((k0 + 1).cast("double") / 100 <= score, k0 + 1)
          .when(k0.cast("double") / 100 > score, k0 - 1).otherwise(k0))
    return F.when(k < GRID_LO, F.lit(GRID_LO - 1)).when(k > GRID_HI, F.lit(GRID_HI)).otherwise(k)


def threshold_sweep(df: DataFrame, by=("model",), label="label", score="score") -> DataFrame:
    """Confusion-derived metrics at every grid threshold, in one pass."""
    by = list(by)
    binned = df.groupBy(*by, _grid_bin(F.col(score)).alias("k")).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"),
        F.count_if(F.col(label) != 1).cast("long").alias("neg"))
    groups = binned.select(*by).distinct()
    grid = groups.select(*by, F.explode(F.sequence(F.lit(GRID_LO - 1).cast("long"),
                                                   F.lit(GRID_HI).cast("long"))).alias("k"))
    full = grid.join(binned, [*by, "k"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*by).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    wall = Window.partitionBy(*by)
    s = full.select(*by, "k", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                    F.sum("pos").over(wall).alias("P"), F.sum("neg").over(wall).alias("N"))
    s = s.filter(F.col("k") >= GRID_LO)
    tp, fp, P, N = F.col("tp"), F.col("fp"), F.col("P"), F.col("N")
    fn, tn = P - tp, N - fp
    return s.select(*by, (F.col("k").cast("double") / 100).alias("threshold"),
                    _div0(2 * tp, 2 * tp + fp + fn).alias("f1"), _div0(tp + tn, P + N).alias("accuracy"),
                    _div0(tp, tp + fp).alias("precision"), _div0(tp, P).alias("recall"))


def best_threshold(sweep: DataFrame, by=("model",), metric: str = "f1") -> DataFrame:
    """Strictly better wins, so the smallest threshold wins ties; 0.5
    when no threshold scores above 0."""
    by = list(by)
    g = sweep.groupBy(*by).agg(
        F.min_by("threshold", F.struct((-F.col(metric)).alias("m"), F.col("threshold").alias("t"))).alias("_t"),
        F.max(metric).alias("best_score"))
    return g.select(*by, F.when(F.col("best_score") > 0, F.col("_t")).otherwise(F.lit(DEFAULT_THRESHOLD))
                    .alias("best_threshold"),
                    F.greatest(F.col("best_score"), F.lit(0.0)).alias("best_score"))


def evaluate_at(df: DataFrame, thresholds: DataFrame, by=("model",), label="label", score="score",
                threshold_col: str = "best_threshold") -> DataFrame:
    """Metrics at each group's threshold (a table with one row per
    group, broadcast) plus AUC."""
    by = list(by)
    t = thresholds.select(*by, F.col(threshold_col).alias("threshold"))
    scored = df.join(F.broadcast(t), by) if by else df.crossJoin(t)
    m = basic_metrics(predict_at(scored, F.col("threshold"), score), [*by, "threshold"], label)
    return m.join(auc(df, by, label, score), by)


def compare_thresholds(df: DataFrame, thresholds=None, by=("model",), label="label",
                       score="score") -> DataFrame:
    """Metrics at a short list of thresholds.  Rows are counted once by
    the number of thresholds they reach; the sums of those few counts are
    the confusion counts, as in the sweep."""
    thresholds = COMPARE_THRESHOLDS if thresholds is None else thresholds
    by = list(by)
    ts = sorted({float(t) for t in thresholds})
    reached = sum(((F.col(score) >= F.lit(t)).cast("int") for t in ts), F.lit(0))
    cells = df.filter(F.col(score).isNotNull()).groupBy(*by, reached.alias("_r")).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"), F.count_if(F.col(label) == 0).cast("long").alias("neg"))
    hit = lambda i, c: F.sum(F.when(F.col("_r") > i, F.col(c)).otherwise(F.lit(0)))
    miss = lambda i, c: F.sum(F.when(F.col("_r") <= i, F.col(c)).otherwise(F.lit(0)))
    wide = cells.groupBy(*by).agg(*[f(i, c).alias(f"{n}{i}") for i in range(len(ts))
                                    for n, f, c in (("tn", miss, "neg"), ("fp", hit, "neg"), ("fn", miss, "pos"), ("tp", hit, "pos"))])
    counts = wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(t).alias("threshold"), *[F.col(f"{n}{i}").alias(n) for n in ("tn", "fp", "fn", "tp")]) for i, t in enumerate(ts)])))
    return with_basic_metrics(counts)
