"""Filters, projections and cleaning.

All operators are narrow: projections and filters that fuse into the scan's
whole-stage codegen and push nothing through a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortframe.functions.columns import present
from cohortframe.schema import DEFAULT_COLUMNS, Columns

# Allowed categories of the whitelisted columns.
VALID_SLEEP = ["Less than 5 hours", "5-6 hours", "6-7 hours", "7-8 hours", "More than 8 hours"]
VALID_DIET = ["Healthy", "Moderate", "Unhealthy"]

# Exact-match invalid professions (degree names, cities,
# genders, ages, family words, personal names, other tokens).
INVALID_PROFESSIONS = [
    "Class", "BSc", "MSc", "BA", "MA", "BBA", "MBA", "B.Com", "M.Com",
    "BCA", "MCA", "BE", "ME", "BTech", "MTech", "B.Tech", "M.Tech",
    "LLB", "LLM", "MD", "MBBS", "BDS", "PhD",
    "City", "Bhopal", "Indore", "Mumbai", "Delhi", "Bangalore", "Chennai",
    "Gender", "Male", "Female", "M", "F",
    "Age", "18", "19", "20", "21", "22", "23", "24", "25",
    "Family", "Father", "Mother", "Brother", "Sister",
    "Yuvraj", "Navya", "Kavya", "Rohan", "Priya", "Ananya", "Arjun",
    "Soham", "Aarav", "Vivaan", "Aditya", "Naina", "Ishaan", "Krishna",
    "Student", "Yes", "No", "None", "Unknown", "NA", "N/A",
]

# Case-insensitive regular expressions of the older
# substring blacklist for professions.
INVALID_PROFESSION_PATTERNS = ["Class", "BSc", "MA", "BBA", "B.Com", "City", "Family",
                               "Yuvraj", "Gender", "Age"]

# Case-sensitive literal fragments a valid degree contains.
VALID_DEGREE_PATTERNS = ["Class", "BSc", "MSc", "BA", "MA", "B.", "M.", "PhD",
                         "BBA", "MBA", "BCA", "MCA", "BE", "ME", "BTech", "MTech",
                         "B.Tech", "M.Tech", "LLB", "LLM", "MD", "BHM", "MHM"]


def drop_columns(df: DataFrame, columns: list[str] | None = None,
                 cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop the listed columns that exist; ``None`` = default list,
    ``[]`` = keep all."""
    columns = list(cols.default_drop) if columns is None else columns
    return df.drop(*present(df, columns)) if columns else df


def _is_missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def missing_fraction(df: DataFrame) -> Column:
    """Share of NULL/NaN cells in a row over *all* columns (id and target
    included)."""
    n = reduce(lambda a, b: a + b, [_is_missing(df, c).cast("int") for c in df.columns])
    return n / F.lit(float(len(df.columns)))


def drop_sparse_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Remove rows whose missing share is >= ``threshold``."""
    return df.filter(missing_fraction(df) < threshold)


def sparse_row_count(df: DataFrame, threshold: float = 0.5) -> int:
    """C2 report: number of rows :func:`drop_sparse_rows` removes."""
    return df.filter(missing_fraction(df) >= threshold).count()


def anomalous_conditions(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> dict[str, Column]:
    is_s = F.col(cols.cohort) == cols.student
    is_p = F.col(cols.cohort) == cols.professional
    conds = {}
    if cols.cgpa in df.columns:
        conds["student_missing_cgpa"] = is_s & F.col(cols.cgpa).isNull()
    if cols.profession in df.columns:
        conds["professional_missing_profession"] = is_p & F.col(cols.profession).isNull()
    if cols.financial_stress in df.columns:
        conds["missing_financial_stress"] = F.col(cols.financial_stress).isNull()
    if cols.diet in df.columns:
        conds["missing_dietary_habits"] = F.col(cols.diet).isNull()
    return {k: F.coalesce(v, F.lit(False)) for k, v in conds.items()}


def drop_anomalous_rows(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C3 (older): drop rows matching any anomalous-missing rule."""
    conds = list(anomalous_conditions(df, cols).values())
    if not conds:
        return df
    return df.filter(~reduce(lambda a, b: a | b, conds))


def anomalous_counts(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C3 report: rows per rule and rows removed in total, one job."""
    conds = anomalous_conditions(df, cols)
    anyc = reduce(lambda a, b: a | b, list(conds.values()))
    one = df.agg(*[F.count_if(v).cast("long").alias(k) for k, v in conds.items()],
                 F.count_if(anyc).cast("long").alias("removed_total"))
    names = list(conds) + ["removed_total"]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("reason"), F.col(k).alias("n_rows"))
                                         for k in names])))


def whitelist(df: DataFrame, allowed: dict[str, list[str]] | None = None,
              cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C4: a value outside the allowed set becomes NULL; NULL stays."""
    allowed = {cols.sleep: VALID_SLEEP, cols.diet: VALID_DIET} if allowed is None else allowed
    return df.select([F.when(F.col(c).isin(allowed[c]), F.col(c)).alias(c) if c in allowed else F.col(c)
                      for c in df.columns])


def blacklist(df: DataFrame, invalid: dict[str, list[str]] | None = None,
              cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Exact-match invalid values become NULL."""
    invalid = {cols.profession: INVALID_PROFESSIONS} if invalid is None else invalid
    return df.select([F.when(~F.col(c).isin(invalid[c]), F.col(c)).alias(c) if c in invalid else F.col(c)
                      for c in df.columns])


def blacklist_table(df: DataFrame, column: str, invalid: DataFrame, value_col: str = "value") -> DataFrame:
    """C5 for long lists: ``invalid`` is a table of values; those of ``column`` that stand in it become NULL.
    The list is made distinct and joined; the planner broadcasts it by its size or joins by shuffle."""
    listed = invalid.select(F.col(value_col).alias("_invalid")).filter(F.col("_invalid").isNotNull()).distinct()
    j = df.join(listed, F.col(column) == F.col("_invalid"), "left")
    return j.select([F.when(F.col("_invalid").isNull(), F.col(column)).alias(c) if c == column else F.col(c) for c in df.columns])


def substring_blacklist(df: DataFrame, patterns: dict[str, list[str]] | None = None,
                        cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C6 (older): case-insensitive regular-expression contains -> NULL."""
    patterns = {cols.profession: INVALID_PROFESSION_PATTERNS} if patterns is None else patterns
    out = []
    for c in df.columns:
        if c in patterns:
            hit = reduce(lambda a, b: a | b, [F.col(c).rlike("(?i)" + p) for p in patterns[c]])
            out.append(F.when(F.coalesce(hit, F.lit(False)), F.lit(None).cast("string"))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(out)


def pattern_whitelist(df: DataFrame, fragments: dict[str, list[str]] | None = None,
                      cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C7 (older): keep a value only if it contains one of the
    case-sensitive literal fragments; NULL kept."""
    fragments = {cols.degree: VALID_DEGREE_PATTERNS} if fragments is None else fragments
    out = []
    for c in df.columns:
        if c in fragments:
            ok = reduce(lambda a, b: a | b, [F.col(c).contains(p) for p in fragments[c]])
            out.append(F.when(F.col(c).isNull() | ok, F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(out)


def prepare_features(df: DataFrame, feature_order: list[str] | None = None,
                     cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop id/name, put the label last (if present) and fix the
    feature order; ``feature_order`` comes from the training frame.  The id
    is kept as the row key (never rely on row order)."""
    have = set(df.columns)
    if feature_order is None:
        feature_order = [c for c in df.columns if c not in (cols.id, cols.name, cols.label)]
    missing = [c for c in feature_order if c not in have]
    if missing:
        raise ValueError(f"prepare_features: columns missing from the frame: {missing}")
    tail = [cols.label] if cols.label in have else []
    keep = [cols.id] if cols.id in have else []
    return df.select(*keep, *feature_order, *tail)


def cohort_filter(df: DataFrame, value: str, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows of one cohort."""
    return df.filter(F.col(cols.cohort) == value)
