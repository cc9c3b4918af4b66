"""Output validation (L1-L2).

A check table ``(file, check, passed, detail)``: column names and order,
row count, ids (each side counted per id, then compared by a full outer join
rather than by row position), no repeated id, label domain {0, 1}, no NULL
cells, id type (warning only).  A missing column fails its checks instead of
raising.  All counts are aggregates; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_output(sub: DataFrame, sample: DataFrame, id_col: str = "id", label_col: str = "label",
                    name: str = "submission") -> DataFrame:
    """L1: one row per check."""
    spark = sub.sparkSession
    same_cols = list(sub.columns) == list(sample.columns)
    id_type_same = (id_col in sub.columns and id_col in sample.columns
                    and sub.schema[id_col].dataType == sample.schema[id_col].dataType)
    static = spark.createDataFrame(
        [("columns", same_cols, f"{sub.columns} vs {sample.columns}"),
         ("id_type", id_type_same, "warning only")],
        "check string, passed boolean, detail string")
    def one(df, *aggs):
        return df.agg(*[x.cast("long").alias(k) for k, x in aggs])

    n_null = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in sub.columns]))
    counted = [("n_sub", F.count(F.lit(1))), ("null_rows", n_null)]
    if label_col in sub.columns:
        counted.append(("bad_labels", F.count_if(~F.col(label_col).isin(0, 1))))
    parts = [one(sub, *counted), one(sample, ("n_sample", F.count(F.lit(1))))]
    if id_col in sub.columns and id_col in sample.columns:
        # each side is counted by itself first, so repeated ids cannot multiply in the join
        a_ids = sub.groupBy(F.col(id_col).alias("_a")).agg(F.count(F.lit(1)).alias("_na"))
        b_ids = sample.groupBy(F.col(id_col).alias("_b")).agg(F.count(F.lit(1)).alias("_nb"))
        both = a_ids.join(b_ids, F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
        gap = F.abs(F.coalesce("_na", F.lit(0)) - F.coalesce("_nb", F.lit(0)))
        parts.append(one(both, ("id_mismatch", F.sum(gap)), ("repeated_ids", F.count_if(F.col("_na") > 1))))
    keys = ("n_sub", "null_rows", "bad_labels", "n_sample", "id_mismatch", "repeated_ids")
    # the single-row aggregates are stacked and folded into one row
    stacked = reduce(lambda a, b: a.unionByName(b), [d.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in d.columns]))) for d in parts])
    j = stacked.agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(k) for k in keys])

    def zero(name, key, text):
        n = F.col(key)
        return F.struct(F.lit(name).alias("check"), F.coalesce(n == 0, F.lit(False)).alias("passed"),
                        F.coalesce(F.concat(n.cast("string"), F.lit(text)), F.lit("column is missing")).alias("detail"))

    dyn = j.na.fill(0, ["id_mismatch"] if id_col in sub.columns and id_col in sample.columns else []).select(F.inline(F.array(
        F.struct(F.lit("row_count").alias("check"), (F.col("n_sub") == F.col("n_sample")).alias("passed"),
                 F.concat(F.col("n_sub").cast("string"), F.lit(" vs "), F.col("n_sample").cast("string")).alias("detail")),
        zero("ids", "id_mismatch", " unmatched ids"), zero("unique_ids", "repeated_ids", " repeated ids"),
        zero("binary_labels", "bad_labels", " values outside {0,1}"), zero("no_nulls", "null_rows", " rows with NULL"))))
    return static.unionByName(dyn).select(F.lit(name).alias("file"), "check", "passed", "detail")


def validate_many(checks: list[DataFrame]) -> DataFrame:
    """L2: every file must pass every check (id type is a warning)."""
    allc = reduce(lambda a, b: a.unionByName(b), checks)
    return allc.filter(F.col("check") != "id_type").agg(F.bool_and("passed").alias("all_passed"),
                                                       F.count_if(~F.col("passed")).alias("n_failed"))
