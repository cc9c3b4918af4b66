"""Seeded splitting, folds and exact sampling.

All of them rest on one primitive, :func:`distributed_row_number`: a
``row_number()`` over (stratum ORDER BY md5(id ':' seed), id) that never routes
a whole stratum through one task.  Rows are first given a coarse bucket that
is monotone in the sort key (the top bits of the hash).  Counting rows per
(stratum, bucket) gives a small table whose prefix sum is each bucket's
offset; the offset is broadcast back and a window partitioned by
(stratum, bucket) numbers the rows inside each bucket.  The result equals the
plain window (the oracle), but the largest sort is one bucket.

Randomness is hash based, so the draw does not depend on partitioning and the
same assignment can be written in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortframe.functions.columns import hash_bucket, hash_hex
from cohortframe.session import cut_lineage

# Rows per (stratum, bucket) the bucket count aims for: a sort of this size is
# cheap for one task, and the offsets table stays far below broadcast limits.
ROWS_PER_BUCKET = 200_000
MAX_BITS = 20


def null_safe_join(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys meet each other; the keys come from ``df``."""
    renamed = table.select([F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in table.columns])
    on = [df[c].eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return df.join(renamed, on, "inner").drop(*[f"_k_{c}" for c in keys])


def bucket_bits(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    if n_rows <= rows_per_bucket:
        return 1
    return min(MAX_BITS, max(1, math.ceil(math.log2(n_rows / rows_per_bucket))))


def distributed_row_number(df: DataFrame, partition_cols: list[str], bucket_col: str,
                           order_cols: list, out: str = "rn",
                           max_offset_rows: int = 2_000_000) -> DataFrame:
    """``row_number()`` over ``partition_cols`` ordered by ``order_cols``.

    ``bucket_col`` must be non-decreasing in ``order_cols`` inside each
    partition.  The offsets table has one row per (partition, bucket); it is
    broadcast when its row count is within ``max_offset_rows`` and joined by
    shuffle otherwise.
    """
    counts = df.groupBy(*partition_cols, bucket_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*partition_cols).orderBy(bucket_col)
    offsets = counts.select(*partition_cols, bucket_col,
                            (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    # the offsets table is small (partitions x buckets): materialise it once
    # in the shared checkpoint folder so the data is not rescanned for it
    offsets = cut_lineage(offsets)
    n_off = offsets.count()
    if n_off <= max_offset_rows:
        offsets = F.broadcast(offsets)
    joined = null_safe_join(df, offsets, [*partition_cols, bucket_col])
    w2 = Window.partitionBy(*partition_cols, bucket_col).orderBy(*order_cols)
    return joined.withColumn(out, F.col("_off") + F.row_number().over(w2)).drop("_off")


def seeded_rank(df: DataFrame, id_col: str, seed: int, strata: list[str] | None = None,
                out: str = "rn", n_rows: int | None = None) -> DataFrame:
    """1-based rank of each row inside its stratum in a seeded random order
    (md5 of ``id ':' seed``, then id).  ``id`` must be unique."""
    strata = list(strata or [])
    if n_rows is None:
        n_rows = df.count()
    bits = bucket_bits(n_rows)
    keyed = (df.withColumn("_h", hash_hex(id_col, seed))
               .withColumn("_b", hash_bucket(id_col, seed, bits)))
    if not strata:
        keyed = keyed.withColumn("_s", F.lit(0))
        parts = ["_s"]
    else:
        parts = strata
    ranked = distributed_row_number(keyed, parts, "_b", [F.col("_h"), F.col(id_col)], out=out)
    drop = ["_h", "_b"] + (["_s"] if not strata else [])
    return ranked.drop(*drop)


def _largest_remainder(counts: dict, n_draws: int) -> dict:
    """Share ``n_draws`` over classes in proportion to ``counts``: floors
    first, the rest by largest remainder, ties to the smaller class."""
    total = sum(counts.values())
    cont = {k: v * n_draws / total for k, v in counts.items()}
    out = {k: math.floor(v) for k, v in cont.items()}
    need = n_draws - sum(out.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - out[k]), k is None, 0 if k is None else k))
    for k in order[:need]:
        out[k] += 1
    return out


def split_quotas(counts: dict, val_size: float) -> dict:
    """Validation rows per class, the way a stratified train/test split
    allocates them: ``ceil(val_size * n)`` validation rows overall; the
    training share is allotted per class first and validation takes the
    rest."""
    n = sum(counts.values())
    n_val = math.ceil(val_size * n)
    train = _largest_remainder(counts, n - n_val)
    return {k: counts[k] - train[k] for k in counts}


def split_stratified(df: DataFrame, id_col: str = "id", label_col: str = "label",
                     val_size: float = 0.2, seed: int = 55,
                     split_col: str = "split") -> DataFrame:
    """Per-class proportional train/validation split; rows without a label are a class of their own."""
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}
    quota = split_quotas(counts, val_size)
    ranked = seeded_rank(df, id_col, seed, [label_col], n_rows=sum(counts.values()))
    q = F.lit(0)
    for k, v in sorted(quota.items(), key=lambda kv: str(kv[0])):
        q = F.when(F.col(label_col).eqNullSafe(F.lit(k)), F.lit(v)).otherwise(q)
    return (ranked.withColumn(split_col, F.when(F.col("rn") <= q, "val")
                              .otherwise("train"))
                  .drop("rn"))


def split_random(df: DataFrame, id_col: str = "id", val_size: float = 0.2, seed: int = 55,
                 split_col: str = "split") -> DataFrame:
    """Same without strata."""
    n = df.count()
    n_val = math.ceil(val_size * n)
    ranked = seeded_rank(df, id_col, seed, None, n_rows=n)
    return (ranked.withColumn(split_col, F.when(F.col("rn") <= n_val, "val").otherwise("train"))
                  .drop("rn"))


def assign_folds(df: DataFrame, id_col: str = "id", k: int = 5, seed: int = 55,
                 label_col: str | None = None, fold_col: str = "fold") -> DataFrame:
    """Shuffled k folds; stratified when ``label_col`` is given
    (the rank inside each class is dealt round-robin, so every fold gets
    the class balance; rows without a label are a class of their own)."""
    strata = [label_col] if label_col else None
    ranked = seeded_rank(df, id_col, seed, strata)
    return ranked.withColumn(fold_col, ((F.col("rn") - 1) % k).cast("int")).drop("rn")


def sample_exact(df: DataFrame, n: int, id_col: str = "id", seed: int = 55) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, seeded."""
    ranked = seeded_rank(df, id_col, seed, None)
    return ranked.filter(F.col("rn") <= n).drop("rn")


def quantile_bucket(df: DataFrame, col: str, n_buckets: int = 1024, out: str = "_b",
                    by: list[str] | None = None) -> DataFrame:
    """Order-preserving, roughly equal-count bucket of ``col``: approximate
    quantile boundaries (one aggregation, a fitted scalar list) and a
    binary-search bucketizer.  Used to split a prefix sum over many tasks."""
    from pyspark.ml.feature import Bucketizer
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, 10000)).first()[0] or []
    splits = [float("-inf")] + sorted({float(b) for b in bounds if b is not None}) + [float("inf")]
    tmp = f"{out}__src"
    bucketed = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep") \
        .transform(df.withColumn(tmp, F.col(col).cast("double")))
    return bucketed.drop(tmp)


def distributed_cumsum(df: DataFrame, partition_cols: list[str], bucket_col: str, order_cols: list,
                       value_cols: list[str], suffix: str = "_cum",
                       max_offset_rows: int = 2_000_000) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_cols`` order per
    partition (``order_cols`` must be unique inside a partition).  Bucket
    totals are prefix-summed on a small table and broadcast back; the
    window that finishes the sum is partitioned by (partition, bucket)."""
    tot = df.groupBy(*partition_cols, bucket_col).agg(*[F.sum(v).alias(v) for v in value_cols])
    w = Window.partitionBy(*partition_cols).orderBy(bucket_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    off = cut_lineage(tot.select(*partition_cols, bucket_col,
                                 *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_o_{v}")
                                   for v in value_cols]))
    if off.count() <= max_offset_rows:
        off = F.broadcast(off)
    j = null_safe_join(df, off, [*partition_cols, bucket_col])
    w2 = Window.partitionBy(*partition_cols, bucket_col).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(*df.columns, *[(F.col(f"_o_{v}") + F.sum(v).over(w2)).alias(v + suffix)
                                   for v in value_cols])
