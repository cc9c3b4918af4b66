"""Model training, search and scoring.

Logistic regression (I1) and random forest (I2) are MLlib pipelines; the three
boosted models (I3-I5) are the second-order trees of
:mod:`cohortframe.operators.boosting`, trained side by side.  Features stay named scalar
columns until the model boundary.  Probabilities of class 1 are read with
``vector_to_array`` or scored over Arrow batches -- no row-wise Python UDF.

Sizes in :data:`FULL` and :data:`BOOSTED` are the defaults everywhere.  Boosters that stop early
(I6) decide it inside training: no round is trained twice and nothing is refitted.
"""

from __future__ import annotations

import json
import math
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortframe.operators import boosting
from cohortframe.operators.boosting import Boosted, Settings, Slot
from cohortframe.operators.evaluate import DEFAULT_THRESHOLD
from cohortframe.operators.search import SEARCH_SPACE, TRIALS, search
from cohortframe.session import cut_lineage

MODELS = ("logistic", "forest", "gbt_a", "gbt_b", "gbt_c")
# Model settings (full size).
FULL = {
    "logistic": {"C": 1.0, "maxIter": 1000},
    "forest": {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 2},
}
BOOSTED = {
    "gbt_a": Settings(rounds=500, depth=5, rate=0.1, growth="level", l1=0.0, l2=0.1, least_gain=0.0, least_weight=1.0, row_share=0.8, column_share=0.8, seed=42),
    "gbt_b": Settings(rounds=500, depth=6, rate=0.1, growth="leaf", leaves=31, l1=0.0, l2=1.0, least_gain=0.0, least_weight=1e-3, least_rows=20, row_share=0.8, column_share=0.8, seed=43),
    "gbt_c": Settings(rounds=500, depth=5, rate=0.1, growth="symmetric", l2=1.25, mean_base=False, seed=44),
}
SEEDS = {"logistic": 42, "forest": 42}
PATIENCE = 50
# Learning rates of the sweep.
LEARNING_RATES = [0.07, 0.1, 0.13, 0.15, 0.17, 0.2, 0.3]


def settings(kind: str, **override) -> dict:
    return {**FULL[kind], **override}


def classifier(kind: str, n_rows: int | None = None, label: str = "label",
               features: str = "features", **override):
    """I1, I2 estimators."""
    s = settings(kind, **override)
    seed = SEEDS[kind]
    if kind == "logistic":
        # sklearn's C-weighted L2 objective equals MLlib's averaged loss with
        # regParam = 1 / (C * n), without internal standardisation.
        n = n_rows or 1
        return LogisticRegression(labelCol=label, featuresCol=features, maxIter=s["maxIter"],
                                  regParam=1.0 / (s["C"] * n), elasticNetParam=0.0,
                                  standardization=False)
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=s["numTrees"],
                                  maxDepth=s["maxDepth"], minInstancesPerNode=s["minInstancesPerNode"],
                                  featureSubsetStrategy="sqrt", seed=seed)


def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def with_label(df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumn(label, F.col(label).cast("double")) if label in df.columns else df


def fit_boosted(train: DataFrame, features: list[str], wanted: dict[str, Settings], label: str = "label", val: DataFrame | None = None,
                id_col: str = "id") -> dict[str, Boosted]:
    """All ``wanted`` boosters over one table of bins.  With ``val`` their history has validation losses (I8), and
    those with patience stop by it; bins are fitted on the training rows."""
    cuts = boosting.fit_bins(train, features)
    rows = train.select(id_col, label, *features).withColumn("_fold", F.lit(0))
    if val is not None:
        rows = rows.unionByName(val.select(id_col, label, *features).withColumn("_fold", F.lit(1)))
    table = boosting.binned(with_label(rows, label), features, cuts, label, id_col, "_fold")
    held = None if val is None else 1
    return dict(zip(wanted, boosting.train(table, features, cuts, [Slot(n, s, held) for n, s in wanted.items()])))


def fit_model(train: DataFrame, features: list[str], kind: str, label: str = "label",
              n_rows: int | None = None, id_col: str = "id", **override) -> PipelineModel | Boosted:
    """Fit one model; the feature list travels with it
    (I17: scoring checks it against the frame)."""
    if kind in BOOSTED:
        return fit_boosted(train, features, {kind: replace(BOOSTED[kind], **override)}, label, id_col=id_col)[kind]
    if kind == "logistic" and n_rows is None:
        n_rows = train.count()
    est = classifier(kind, n_rows, label, **override)
    return Pipeline(stages=[assembler(features), est]).fit(with_label(train, label))


def model_features(model: PipelineModel | Boosted) -> list[str]:
    return list(model.features) if isinstance(model, Boosted) else list(model.stages[0].getInputCols())


def probability(m: Column) -> Column:
    """Of class 1, from log-odds."""
    return 1 / (1 + F.exp(-m))


def score(model: PipelineModel | Boosted, df: DataFrame, threshold: float = DEFAULT_THRESHOLD,
          keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Probability of class 1 and the label at ``threshold`` (>=).
    I17: the frame must carry every feature the model was trained on."""
    feats = model_features(model)
    missing = [c for c in feats if c not in df.columns]
    if missing:
        raise ValueError(f"frame lacks features the model was trained on: {missing}")
    keep = [c for c in (keep or []) if c in df.columns]
    if isinstance(model, Boosted):
        t, p1 = boosting.with_margins(df, {"_margin": model}, keep), probability(F.col("_margin"))
    else:
        t = model.transform(df.select(*keep, *[c for c in feats if c not in keep]))
        p1 = vector_to_array(F.col("probability"))[1]
    return t.select(*keep, p1.alias(out), (p1 >= F.lit(threshold)).cast("int").alias("prediction"))


def margin(model: PipelineModel | Boosted, df: DataFrame, keep: list[str] | None = None, out: str = "margin") -> DataFrame:
    """Log-odds of class 1 for every model type (LR and boosters: raw margin;
    forest: logit of the clipped probability)."""
    keep = keep or []
    if isinstance(model, Boosted):
        return boosting.with_margins(df, {"_margin": model}, keep).withColumnRenamed("_margin", out)
    t = model.transform(df)
    raw = vector_to_array(F.col("rawPrediction"))
    prob = vector_to_array(F.col("probability"))[1]
    if type(model.stages[-1]).__name__.startswith("LogisticRegression"):
        m = raw[1]  # the first entry is its negative
    else:
        p = F.least(F.greatest(prob, F.lit(1e-6)), F.lit(1 - 1e-6))
        m = F.log(p / (1 - p))
    return t.select(*keep, m.alias(out))


# ------------------------------------------------------------ loss, history

def _logloss_expr(y: Column, p: Column, eps=1e-15) -> Column:
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def logloss(model: PipelineModel, df: DataFrame, label: str = "label") -> float:
    s = score(model, with_label(df, label), keep=[label])
    return s.agg(F.avg(_logloss_expr(F.col(label), F.col("score")))).first()[0]


def train_early_stop(train: DataFrame, val: DataFrame, features: list[str], kind: str,
                     label: str = "label", patience: int = PATIENCE, **override):
    """Stop after ``patience`` rounds without a better validation loss and
    keep the best round.  Returns (model, history rows up to the stop, best round)."""
    model = fit_boosted(train, features, {kind: replace(BOOSTED[kind], patience=patience, **override)}, label, val)[kind]
    return model, model.history, len(model.trees)


def history_frame(spark, rows: list[tuple], model_name: str) -> DataFrame:
    return spark.createDataFrame([(model_name, i, a, b) for i, a, b, *_ in rows],
                                 "model string, iteration int, train_loss double, val_loss double")


def history_summary(hist: DataFrame) -> DataFrame:
    """I8 summary: best round, best validation loss and total rounds per model."""
    return hist.groupBy("model").agg(
        F.min_by("iteration", F.struct("val_loss", "iteration")).alias("best_iteration"),
        F.min("val_loss").alias("best_val_loss"), F.max("iteration").alias("total_rounds"))


# ------------------------------------------------------------ CV and search

def fold_rows(df: DataFrame, features: list[str], fold_col: str = "fold", label: str = "label", id_col: str = "id", n_folds: int = 5,
              oversample=None) -> DataFrame:
    """``(id, label, fold, group, features...)``: the rows with their fold and, with ``oversample`` (frame -> frame with ``synthetic``), those
    made from the training rows of each fold, which only the model that holds this fold out may see."""
    keep = [id_col, label, *features]
    out = df.select(*keep, F.col(fold_col).cast("int").alias("_fold"), F.lit(None).cast("int").alias("_group"))
    for k in range(n_folds) if oversample else ():
        made = oversample(df.filter(F.col(fold_col) != k).select(*keep)).filter("synthetic = 1")
        out = out.unionByName(made.select(*keep, F.lit(None).cast("int").alias("_fold"), F.lit(k).alias("_group")))
    return out


def f1(counts: tuple) -> float:
    tp, fp, fn = counts
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def cross_validate(df: DataFrame, features: list[str], kind: str, fold_col: str = "fold",
                   label: str = "label", n_folds: int = 5, oversample=None, id_col: str = "id", **override) -> list[float]:
    """Positive-class F1 on each (stratified) fold.  The boosters of all folds train side by side, and are judged
    as they train; rows are oversampled inside each fold's training part only."""
    if kind in BOOSTED:
        table = boosted_folds(df, features, fold_col, label, id_col, n_folds, oversample)
        return _fold_scores(table, features, [replace(BOOSTED[kind], **override)], n_folds, bool(oversample))[0]
    out = []
    for k in range(n_folds):
        part = df.filter(F.col(fold_col) != k)
        if oversample:
            part = oversample(part.select(id_col, label, *features))
        m = fit_model(part, features, kind, label, **override)
        held = score(m, df.filter(F.col(fold_col) == k), keep=[label])
        hit, y = F.col("prediction") == 1, F.col(label) == 1
        out.append(f1(held.agg(F.count_if(hit & y), F.count_if(hit & ~y), F.count_if(~hit & y)).first()))
    return out


def boosted_folds(df: DataFrame, features: list[str], fold_col: str, label: str, id_col: str, n_folds: int, oversample) -> tuple[DataFrame, list]:
    """The table of bins that the models of all folds read, and its cuts."""
    rows = fold_rows(with_label(df, label), features, fold_col, label, id_col, n_folds, oversample)
    cuts = boosting.fit_bins(df, features)
    return cut_lineage(boosting.binned(rows, features, cuts, label, id_col, "_fold", "_group")), cuts


def _fold_scores(table: tuple[DataFrame, list], features: list[str], tried: list[Settings], n_folds: int, grouped: bool) -> list[list[float]]:
    """F1 of each of the settings on each fold, all trained in one scan."""
    slots = [Slot(f"{i}-{k}", s, k, k if grouped else None) for i, s in enumerate(tried) for k in range(n_folds)]
    got = boosting.train(table[0], features, table[1], slots, segment=max(s.rounds for s in tried), keep_trees=False)
    scores = [f1(m.history[-1][3:]) for m in got]
    return [scores[i * n_folds:(i + 1) * n_folds] for i in range(len(tried))]


def mean_and_range(scores: list[float]) -> tuple[float, float, float, float]:
    """Mean, standard deviation, and mean -+ two of them."""
    mean = sum(scores) / len(scores)
    std = math.sqrt(sum((x - mean) ** 2 for x in scores) / len(scores))
    return mean, std, mean - 2 * std, mean + 2 * std


def search_params(df: DataFrame, features: list[str], kind: str, n_trials: int = TRIALS, fold_col: str = "fold", label: str = "label", seed: int = 55,
                  n_folds: int = 5, oversample=None, id_col: str = "id", space: dict | None = None) -> DataFrame:
    """Tree-structured Parzen search by mean positive-class F1 over the folds.  A batch's trials train together;
    if that fails they run apart, one that fails alone scores 0.0 and keeps its error."""
    table = boosted_folds(df, features, fold_col, label, id_col, n_folds, oversample)
    grouped = bool(oversample)

    def evaluate(batch: list[dict]) -> list[tuple[float, str | None]]:
        tried = [replace(BOOSTED[kind], **d) for d in batch]
        try:
            return [(sum(f) / len(f), None) for f in _fold_scores(table, features, tried, n_folds, grouped)]
        except Exception as e:  # noqa: BLE001 -- recorded in the trial's row
            if len(batch) == 1:
                return [(0.0, f"{type(e).__name__}: {str(e)[:300]}")]
            return [r for d in batch for r in evaluate([d])]

    done = search(space or SEARCH_SPACE[kind], evaluate, n_trials, seed)
    rows = [(i, json.dumps(d, sort_keys=True), f, e) for i, (d, f, e) in enumerate(done)]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, mean_f1 double, error string")


def rate_results(train: DataFrame, val: DataFrame, features: list[str], kind: str = "gbt_a", rates=None,
                 id_col: str = "id", label: str = "label", patience: int = PATIENCE, max_rounds: int = 1000) -> DataFrame:
    """Accuracy, F1, AUC and rounds of each learning rate, each trained
    with early stopping; all rates train and are scored side by side."""
    from cohortframe.operators.evaluate import auc, basic_metrics
    rates = [float(r) for r in (LEARNING_RATES if rates is None else rates)]
    fitted = fit_boosted(train, features, {f"_r{i}": replace(BOOSTED[kind], rounds=max_rounds, rate=r, patience=patience) for i, r in enumerate(rates)}, label, val, id_col)
    wide = boosting.with_margins(val, fitted, [id_col, label])
    s = wide.select(id_col, label, F.inline(F.array(*[F.struct(F.lit(r).alias("rate"), probability(F.col(f"_r{i}")).alias("score")) for i, r in enumerate(rates)])))
    s = cut_lineage(s.withColumn("prediction", (F.col("score") >= DEFAULT_THRESHOLD).cast("int")))
    n = F.broadcast(df_of(train, [(r, len(fitted[f"_r{i}"].trees)) for i, r in enumerate(rates)], "rate double, rounds int"))
    return basic_metrics(s, ["rate"], label).join(auc(s, ["rate"], label), "rate").join(n, "rate").select("rate", "accuracy", "f1", "auc", "rounds")


def df_of(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


RATE_METRICS = ("accuracy", "f1", "auc")


def best_rates(results: DataFrame) -> DataFrame:
    """For each metric the rate with the highest value; the first one
    tried (the smallest) wins ties."""
    long = results.select("rate", "rounds", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in RATE_METRICS])))
    return long.groupBy("metric").agg(
        F.min_by(F.struct("rate", "rounds", "value"), F.struct((-F.col("value")).alias("v"), F.col("rate"))).alias("b")) \
        .select("metric", "b.rate", "b.value", "b.rounds")


def compare_rates(results: DataFrame, rates) -> DataFrame:
    """The chosen rates with their metrics, best accuracy first."""
    return results.filter(F.col("rate").isin([float(r) for r in rates])).orderBy(F.desc("accuracy"), "rate")


# ------------------------------------------------------------ ensembles

def ensemble_mean(df: DataFrame, score_cols: list[str], out: str = "ensemble_score") -> DataFrame:
    """Mean of the members' probabilities (columns of one table)."""
    s = score_cols[0]
    tot = F.col(s)
    for c in score_cols[1:]:
        tot = tot + F.col(c)
    return df.withColumn(out, tot / F.lit(float(len(score_cols))))


def ensemble_threshold(best: DataFrame, enabled: bool = True, manual: float = 0.55,
                       col: str = "best_threshold") -> DataFrame:
    """Mean of the members' best thresholds (missing -> 0.5); the
    manual value when tuning is disabled or no threshold exists."""
    if not enabled:
        return best.sparkSession.createDataFrame([(manual,)], "threshold double")
    g = best.agg(F.avg(F.coalesce(F.col(col), F.lit(DEFAULT_THRESHOLD))).alias("t"))
    return g.select(F.coalesce(F.col("t"), F.lit(manual)).alias("threshold"))


def ensemble_predict(df: DataFrame, score_cols: list[str], threshold: float) -> DataFrame:
    e = ensemble_mean(df, score_cols)
    return e.withColumn("prediction", (F.col("ensemble_score") >= F.lit(float(threshold))).cast("int"))


def prediction_distribution(pred: DataFrame, col: str = "prediction") -> DataFrame:
    """I16: count and percent per predicted class (window over the grouped
    result only)."""
    from pyspark.sql import Window
    g = pred.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.select(col, "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))


# ------------------------------------------------------------ persistence (A4)

def save_models(models: dict, path: str) -> None:
    """A4: one folder per model name."""
    for name, m in models.items():
        if isinstance(m, Boosted):
            boosting.save(SparkSession.active(), m, f"{path}/{name}")
        else:
            m.write().overwrite().save(f"{path}/{name}")


def load_models(spark, path: str, names=MODELS) -> dict:
    """A4: a model without a folder is skipped; any other failure is raised."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def there(at: str) -> bool:
        folder = jvm.org.apache.hadoop.fs.Path(at)
        return folder.getFileSystem(conf).exists(folder)

    out = {}
    for n in names:
        if there(f"{path}/{n}"):
            out[n] = boosting.load(spark, f"{path}/{n}") if there(f"{path}/{n}/boosted") else PipelineModel.load(f"{path}/{n}")
    return out


def save_metadata(spark, path: str, feature_set: str, features: list[str]) -> None:
    """Which feature set and columns the models were trained on."""
    spark.createDataFrame([(feature_set, list(features))], "feature_set string, features array<string>") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def check_metadata(spark, path: str, feature_set: str) -> list[str]:
    """The columns the models need.  Missing metadata, or models of
    another feature set, are errors."""
    row = spark.read.schema("feature_set string, features array<string>").json(f"{path}/metadata").first()
    if row is None or row["feature_set"] != feature_set:
        raise ValueError(f"models were trained on feature set {row and row['feature_set']!r}, not {feature_set!r}")
    return list(row["features"])
