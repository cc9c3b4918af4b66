"""Column-expression helpers shared by all operators.

Everything here returns a :class:`pyspark.sql.Column` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def present(df: DataFrame, cols) -> list[str]:
    """Subset of ``cols`` that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def nan_to_null(c: str | Column) -> Column:
    """NaN and +-inf become NULL (Spark sorts NaN as the largest value and
    lets it into median/percentile, so it must never reach an aggregate)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None)).otherwise(col)


def clean_doubles(df: DataFrame) -> DataFrame:
    """Replace NaN/inf by NULL in every floating column, in one projection."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not fl:
        return df
    return df.select([nan_to_null(c).alias(c) if c in fl else F.col(c) for c in df.columns])


def flag(cond: Column) -> Column:
    """0/1 integer of a condition; NULL comparisons count as false (pandas
    ``(x >= m).astype(int)`` on NaN gives 0)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_div(a: Column, b: Column) -> Column:
    """Division that yields NULL instead of raising (ANSI) or producing inf."""
    return nan_to_null(F.try_divide(a.cast("double"), b.cast("double")))


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, cols)


def row_count_notnull(cols: list[str]) -> Column:
    return _sum([F.col(c).isNotNull().cast("int") for c in cols])


def row_mean(cols: list[str]) -> Column:
    """Mean over the non-NULL inputs of a row (numpy ``nanmean``); NULL when
    all inputs are NULL."""
    if len(cols) == 1:
        return F.col(cols[0]).cast("double")
    n = row_count_notnull(cols)
    s = _sum([F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    return F.when(n > 0, s / n)


def row_max(cols: list[str]) -> Column:
    """NULL-skipping row maximum (numpy ``nanmax``)."""
    if len(cols) == 1:
        return F.col(cols[0]).cast("double")
    return F.greatest(*[F.col(c).cast("double") for c in cols])


def row_var_pop(cols: list[str]) -> Column:
    """Population variance over the non-NULL inputs (``nanvar(ddof=0)``)."""
    n = row_count_notnull(cols)
    m = row_mean(cols)
    sq = _sum([F.when(F.col(c).isNotNull(), (F.col(c).cast("double") - m) ** 2)
               .otherwise(F.lit(0.0)) for c in cols])
    return F.when(n > 0, sq / n)


def plain_mean(cols: list[str]) -> Column:
    """Mean that propagates NULL (``sum(cols) / len(cols)`` in pandas)."""
    return _sum([F.col(c).cast("double") for c in cols]) / F.lit(float(len(cols)))


def plain_max(cols: list[str]) -> Column:
    """Row max that propagates NULL (``np.maximum.reduce``)."""
    if len(cols) == 1:
        return F.col(cols[0]).cast("double")
    anynull = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return F.when(~anynull, F.greatest(*[F.col(c).cast("double") for c in cols]))


def plain_var_pop(cols: list[str]) -> Column:
    """Population variance that propagates NULL (``np.var``)."""
    m = plain_mean(cols)
    return _sum([(F.col(c).cast("double") - m) ** 2 for c in cols]) / F.lit(float(len(cols)))


def hash_hex(id_col: str | Column, seed: int) -> Column:
    """md5 of ``id ':' seed`` -- identical in Spark and DuckDB, independent
    of partitioning, so every seeded draw has an SQL oracle."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(":"), F.lit(str(seed))))


def hash_uniform(id_col: str | Column, seed: int) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of :func:`hash_hex`."""
    h = F.conv(F.substring(hash_hex(id_col, seed), 1, 8), 16, 10).cast("long")
    return h.cast("double") / F.lit(4294967296.0)


def hash_bucket(id_col: str | Column, seed: int, bits: int) -> Column:
    """Top ``bits`` bits of the 32-bit hash prefix: an order-preserving coarse
    key of :func:`hash_hex` (bucket order = md5 text order)."""
    h = F.conv(F.substring(hash_hex(id_col, seed), 1, 8), 16, 10).cast("long")
    return F.shiftright(h, 32 - bits)


def safe_name(name: str) -> str:
    """Feature name rule for generated products: blanks and '/' become '_',
    '?' is removed."""
    return name.replace(" ", "_").replace("?", "").replace("/", "_")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (used only for presenting results to an
    order-sensitive comparison; sums are order-dependent in the last bits)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([F.round(F.col(c), digits).alias(c) if c in fl else F.col(c)
                      for c in df.columns])
