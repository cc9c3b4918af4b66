"""End-to-end plans: prepare (fit on train, apply everywhere), train, score,
tune thresholds, evaluate, and predict new rows.

``prepare`` runs every fit step on the training split only and applies the
fitted parameter tables to the training and validation rows; the training
rows are then oversampled.  :func:`apply_prepared` applies the same tables to
any further table, so raw rows, parameters, models and thresholds lead to a
submission (:func:`predict`).  The prepared frames are checkpointed to the
shared checkpoint folder, so the model fits reuse them and a lost executor
reads the checkpoint, not the raw scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortframe.functions.columns import numeric_columns
from cohortframe.operators import clean, encode, evaluate, features, impute, models, resample, scale
from cohortframe.operators.boosting import Boosted, with_margins
from cohortframe.operators.rank import split_stratified
from cohortframe.params import Params
from cohortframe.schema import DEFAULT_COLUMNS, Columns
from cohortframe.session import compiled_methods, cut_lineage

ENSEMBLE = ("gbt_a", "gbt_b", "gbt_c")


@dataclass
class Prepared:
    train: DataFrame
    val: DataFrame
    features: list
    params: dict = field(default_factory=dict)
    options: dict = field(default_factory=dict)
    cal: DataFrame | None = None

    @property
    def judges(self) -> DataFrame:
        """Rows that stop training and tune thresholds: the calibration rows if there are any, else the validation rows."""
        return self.val if self.cal is None else self.cal


def _cleaned(df: DataFrame, cols: Columns) -> DataFrame:
    df = clean.drop_columns(df, None, cols)
    df = clean.whitelist(df, None, cols)
    return clean.blacklist(df, None, cols)


def _built(df: DataFrame, p: dict, cols: Columns, feature_set: str) -> DataFrame:
    if feature_set == "none":
        return df
    return (features.all_features if feature_set == "current" else features.all_features_v1)(df, p["features"], cols)


def prepare(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, encoding: str = "label",
            scaling: str = "standard", val_size: float = 0.2, seed: int = 55,
            feature_set: str = "current", checkpoint: bool = True, sparse: float | None = 0.5,
            smote: bool = True, calibration: float | None = None) -> Prepared:
    """Rows missing at least ``sparse`` of their values go; the rest is split
    first, then every statistic is fitted on the training rows only, and
    last the training rows are oversampled (``smote``).  With ``calibration`` this share of the validation
    rows (stratified) is set apart to stop training and tune thresholds, so that the rest is judged only."""
    with compiled_methods(df.sparkSession):
        if sparse is not None:
            df = clean.drop_sparse_rows(df, sparse)
        sp = split_stratified(_cleaned(df, cols), cols.id, cols.label, val_size, seed)
        if checkpoint:
            sp = cut_lineage(sp)
        train = sp.filter(F.col("split") == "train").drop("split")
        val = sp.filter(F.col("split") == "val").drop("split")
        p = {}
        # every parameter table is collected once and handed on as scalars
        p["impute"] = Params.collect(impute.fit_impute(train, cols), impute.STAGE)
        train, val = impute.apply_impute(train, p["impute"], cols), impute.apply_impute(val, p["impute"], cols)
        train, p["encode"] = encode.encode(train, None, encoding, True, cols.label, cols)
        val, _ = encode.encode(val, p["encode"], encoding, False, cols.label, cols)
        if checkpoint:
            train = cut_lineage(train)  # the fits below read it several times
        p["clip"] = Params.collect(impute.fit_clip(train, {cols.hours: (0.0, 24.0), cols.cgpa: (0.0, 10.0)}), impute.CLIP_STAGE)
        train, val = impute.apply_clip(train, p["clip"]), impute.apply_clip(val, p["clip"])
        if feature_set != "none":
            p["features"] = features.fit_features(train, cols)
            train, val = _built(train, p, cols, feature_set), _built(val, p, cols, feature_set)
        excl = (cols.id, cols.label)
        p["fill"] = Params.collect(impute.fit_fill(train, exclude=excl), impute.FILL_STAGE)
        train, val = impute.apply_fill(train, p["fill"], excl), impute.apply_fill(val, p["fill"], excl)
        feats = numeric_columns(train, exclude=excl)
        p["scale"] = Params.collect(scale.fit_scale(train, feats, scaling, exclude=excl), scale.STAGE)
        train, val = scale.apply_scale(train, p["scale"], scaling), scale.apply_scale(val, p["scale"], scaling)
        # models cannot take NULL (an all-NULL training column keeps its NULL):
        # constant 0.0 then, never split on
        keep = [cols.id, cols.label] + feats
        train, val = train.fillna(0.0, subset=feats).select(keep), val.fillna(0.0, subset=feats).select(keep)
        if checkpoint:
            train, val = cut_lineage(train), cut_lineage(val)
        cal = None
        if calibration:
            val = split_stratified(val, cols.id, cols.label, calibration, seed + 1)
            val = cut_lineage(val) if checkpoint else val
            val, cal = (val.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
        prep = Prepared(train, val, feats, p, {"encoding": encoding, "scaling": scaling, "feature_set": feature_set}, cal)
        return oversampled(prep, cols, checkpoint) if smote else prep


def oversampled(prep: Prepared, cols: Columns = DEFAULT_COLUMNS, checkpoint: bool = True) -> Prepared:
    """The same preparation with its training rows oversampled."""
    with compiled_methods(prep.train.sparkSession):
        train = resample.smote(prep.train, prep.features, cols.label, cols.id).select(cols.id, cols.label, *prep.features)
        return replace(prep, train=cut_lineage(train) if checkpoint else train)


def fold_oversampler(prep: Prepared, cols: Columns = DEFAULT_COLUMNS):
    """Oversampling to hand to cross-validation and search, which call it on the training part of each fold: no made row
    has a parent in the fold that judges it."""
    return lambda part: resample.smote(part, prep.features, cols.label, cols.id)


def apply_prepared(df: DataFrame, prep: Prepared, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The fitted parameters applied to further rows: (id, [label], features).
    No row is dropped; nothing is learned from these rows."""
    p, o = prep.params, prep.options
    out = impute.apply_impute(_cleaned(df, cols), p["impute"], cols)
    out, _ = encode.encode(out, p["encode"], o["encoding"], False, cols.label, cols)
    out = _built(impute.apply_clip(out, p["clip"]), p, cols, o["feature_set"])
    excl = (cols.id, cols.label)
    out = scale.apply_scale(impute.apply_fill(out, p["fill"], excl), p["scale"], o["scaling"])
    missing = [f for f in prep.features if f not in out.columns]
    if missing:
        raise ValueError(f"rows lack features the models were trained on: {missing}")
    keep = [c for c in excl if c in out.columns] + prep.features
    return out.fillna(0.0, subset=prep.features).select(keep)


def train_all(prep: Prepared, kinds=models.MODELS, label: str = "label", **override) -> dict:
    """The boosted members train side by side and keep their losses on the validation rows; ``override`` replaces their settings."""
    wanted = {k: replace(models.BOOSTED[k], **override) for k in kinds if k in models.BOOSTED}
    n = prep.train.count()
    out = {k: models.fit_model(prep.train, prep.features, k, label, n_rows=n) for k in kinds if k not in wanted}
    if wanted:
        out |= models.fit_boosted(prep.train, prep.features, wanted, label, prep.judges)
    return {k: out[k] for k in kinds}


def score_wide(fitted: dict, frame: DataFrame, keep: list[str], ensemble=ENSEMBLE) -> DataFrame:
    """A probability column ``p_<model>`` for each model, all on one frame,
    and ``p_ensemble``, the mean of the boosted members: one scan, no shuffle."""
    boosted = {n: m for n, m in fitted.items() if isinstance(m, Boosted)}
    plain = {n: m for n, m in fitted.items() if n not in boosted}
    out = next(iter(plain.values())).stages[0].transform(frame) if plain else frame
    for name, m in plain.items():
        est = m.stages[-1].copy().setProbabilityCol(f"_v_{name}").setPredictionCol("").setRawPredictionCol(f"_r_{name}")
        out = est.transform(out).withColumn(f"p_{name}", vector_to_array(F.col(f"_v_{name}"))[1])
    if boosted:
        out = with_margins(out, {f"_m_{n}": m for n, m in boosted.items()}, [*keep, *(f"p_{n}" for n in plain)])
        out = out.withColumns({f"p_{n}": models.probability(F.col(f"_m_{n}")) for n in boosted})
    members = [F.col(f"p_{e}") for e in ensemble if e in fitted]
    cols = [f"p_{n}" for n in fitted]
    if members:
        out = out.withColumn("p_ensemble", sum(members[1:], members[0]) / float(len(members)))
        cols.append("p_ensemble")
    return out.select(*keep, *cols)


def score_long(fitted: dict, prep: Prepared, id_col: str = "id", label: str = "label", ensemble=ENSEMBLE) -> DataFrame:
    """(id, label, model, dataset, score) for every model, the ensemble and
    split: each frame is scored once and unpivoted."""
    parts = []
    for ds, frame in (("Train", prep.train), ("Validation", prep.val), *([("Calibration", prep.cal)] if prep.cal is not None else [])):
        wide = score_wide(fitted, frame, [id_col, label], ensemble)
        names = [c.removeprefix("p_") for c in wide.columns if c.startswith("p_")]
        parts.append(wide.select(id_col, label, F.lit(ds).alias("dataset"), F.inline(F.array(*[
            F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("score")) for n in names]))))
    return reduce(DataFrame.unionByName, parts).select(id_col, label, "model", "dataset", "score")


def tune(long: DataFrame, label: str = "label", on: str = "Validation") -> DataFrame:
    """J15 on trained models: the best F1 threshold of each on the validation (or calibration) rows."""
    val = long.filter(F.col("dataset") == on)
    return evaluate.best_threshold(evaluate.threshold_sweep(val, ["model"], label, "score"), ["model"])


def predict(df: DataFrame, prep: Prepared, fitted: dict, thresholds: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """(id, score, prediction) of raw rows: parameters applied, boosted
    members averaged, the mean of their thresholds (I15)."""
    members = [m for m in ENSEMBLE if m in fitted]
    t = models.ensemble_threshold(thresholds.filter(F.col("model").isin(members))).first()["threshold"]
    wide = score_wide({m: fitted[m] for m in members}, apply_prepared(df, prep, cols), [cols.id])
    return wide.select(cols.id, F.col("p_ensemble").alias("score"), (F.col("p_ensemble") >= F.lit(float(t))).cast("int").alias("prediction"))


def pipeline_metrics(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, kinds=models.MODELS, prep: Prepared | None = None,
                     fitted: dict | None = None, **override) -> DataFrame:
    """Prepare -> five models + ensemble -> metrics for every (model,
    dataset) in one evaluation plan, with each model's tuned threshold."""
    prep = prep or prepare(df, cols)
    fitted = fitted or train_all(prep, kinds, cols.label, **override)
    # scored once, checkpointed: the metric, AUC, log-loss and threshold branches all
    # read the same table instead of re-scoring every model
    long = cut_lineage(score_long(fitted, prep, cols.id, cols.label))
    out = evaluate.evaluate_all(long, ["model", "dataset"], cols.label, "score").drop("tn", "fp", "fn", "tp")
    return out.join(tune(long, cols.label, "Validation" if prep.cal is None else "Calibration").select("model", "best_threshold"), "model")
