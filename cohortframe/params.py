"""Fitted-parameter tables.

Every fit step returns a long DataFrame with the schema
``(stage, feature, cohort, stat, value DOUBLE, value_str STRING)``.  They are
small (one row per column, cohort and statistic, or one row per category for
encoders), can be written with :func:`cohortframe.sources.tables.write_params`
and re-read to score new data.  Applying them collects only those fitted
scalars to the driver and turns them into literal expressions, so the apply
step is a single projection fused by whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAM_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType(), False),
    T.StructField("feature", T.StringType(), True),
    T.StructField("cohort", T.StringType(), True),
    T.StructField("stat", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("value_str", T.StringType(), True),
])

ALL = "all"  # cohort value of statistics learned over every row


def param_rows(stage: str, items: list[tuple[str, str, str, Column]]) -> list[Column]:
    """Struct columns for :func:`long_params` from (feature, cohort, stat,
    value-expression) tuples; string expressions go to ``value_str``."""
    out = []
    for feature, cohort, stat, expr in items:
        out.append((feature, cohort, stat, expr))
    return out


def long_params(one_row: DataFrame, stage: str, specs: list[tuple[str, str, str, str, bool]]) -> DataFrame:
    """Turn a one-row aggregate into the long parameter layout.

    ``specs``: (agg column, feature, cohort, stat, is_string).  The unpivot
    runs on the single aggregated row, never on the data.
    """
    structs = [F.struct(F.lit(stage).alias("stage"), F.lit(f).alias("feature"),
                        F.lit(c).alias("cohort"), F.lit(s).alias("stat"),
                        (F.lit(None).cast("double") if is_str else F.col(a).cast("double")).alias("value"),
                        (F.col(a).cast("string") if is_str else F.lit(None).cast("string")).alias("value_str"))
               for a, f, c, s, is_str in specs]
    if not structs:
        return one_row.sparkSession.createDataFrame([], PARAM_SCHEMA)
    return one_row.select(F.inline(F.array(*structs)))


def empty_params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PARAM_SCHEMA)


class Params:
    """Driver-side view of a (small) parameter table."""

    def __init__(self, rows):
        self._d = {}
        for r in rows:
            self._d[(r["stage"], r["feature"], r["cohort"], r["stat"])] = (r["value"], r["value_str"])

    @classmethod
    def collect(cls, params: DataFrame, stage: str | None = None) -> "Params":
        if stage is not None:
            params = params.filter(F.col("stage") == stage)
        return cls(params.collect())

    def __bool__(self) -> bool:
        return bool(self._d)

    def has(self, stage, feature, cohort, stat) -> bool:
        return (stage, feature, cohort, stat) in self._d

    def value(self, stage, feature, cohort, stat):
        return self._d[(stage, feature, cohort, stat)][0]

    def value_str(self, stage, feature, cohort, stat):
        return self._d[(stage, feature, cohort, stat)][1]

    def items(self, stage=None):
        return [(k, v) for k, v in self._d.items() if stage is None or k[0] == stage]


def lit_double(v) -> Column:
    return F.lit(v).cast("double")
