"""Survey-shaped inputs derived from the driver's tables.

The same SQL text builds the inputs on Spark and in the DuckDB oracle, so a
query and its oracle start from identical rows.  On Spark the tables are
passed as DataFrames (``spark.sql(text, orders=df, ...)``), so column pruning
and filter pushdown reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortframe.sources.tables import read_table

# One row per order: two cohorts, structural and anomalous NULLs, junk
# categories, an hour outlier (90) and string Yes/No flags.
COHORT_SQL = """
SELECT
  o.o_orderkey                                             AS id,
  c.c_name                                                 AS name,
  CASE WHEN c.c_nationkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CAST(18 + o.o_orderkey % 43 AS DOUBLE)                   AS age,
  n.n_name                                                 AS city,
  CASE WHEN o.o_custkey % 5 = 0 THEN 'Student' ELSE 'Working Professional' END AS cohort,
  CASE WHEN o.o_custkey % 5 = 0 AND o.o_orderkey % 11 <> 0 THEN NULL
       WHEN o.o_orderkey % 17 = 0 THEN NULL
       WHEN o.o_orderkey % 101 = 0 THEN 'MBA'
       ELSE c.c_mktsegment END                             AS profession,
  CASE WHEN o.o_custkey % 5 = 0 AND o.o_orderkey % 19 <> 0
       THEN CAST(1 + o.o_orderkey % 5 AS DOUBLE) END       AS academic_pressure,
  CASE WHEN o.o_custkey % 5 <> 0 AND o.o_orderkey % 23 <> 0
       THEN CAST(1 + o.o_orderkey % 5 AS DOUBLE) END       AS work_pressure,
  CASE WHEN o.o_custkey % 5 = 0 AND o.o_orderkey % 29 <> 0
       THEN 5 + CAST(o.o_orderkey % 500 AS DOUBLE) / 100 END AS cgpa,
  CASE WHEN o.o_custkey % 5 = 0 AND o.o_orderkey % 31 <> 0
       THEN CAST(1 + o.o_orderkey % 4 AS DOUBLE) END       AS study_satisfaction,
  CASE WHEN o.o_custkey % 5 <> 0 AND o.o_orderkey % 37 <> 0
       THEN CAST(1 + o.o_orderkey % 4 AS DOUBLE) END       AS job_satisfaction,
  CASE WHEN o.o_orderkey % 97 = 0 THEN '9-5 hours'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Less than 5 hours'
       WHEN o.o_orderpriority = '2-HIGH'   THEN '5-6 hours'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN '6-7 hours'
       WHEN o.o_orderpriority = '5-LOW'    THEN 'More than 8 hours'
       ELSE '7-8 hours' END                                AS sleep_duration,
  CASE WHEN o.o_orderkey % 89 = 0 THEN NULL
       WHEN o.o_custkey % 3 = 0 THEN 'Healthy'
       WHEN o.o_custkey % 3 = 1 THEN 'Moderate'
       ELSE 'Unhealthy' END                                AS dietary_habits,
  CASE WHEN o.o_orderkey % 71 = 0 THEN 'Rohan'
       WHEN o.o_custkey % 4 = 0 THEN 'BSc'
       WHEN o.o_custkey % 4 = 1 THEN 'B.Tech'
       ELSE 'Class 12' END                                 AS degree,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS suicidal,
  CASE WHEN o.o_orderkey % 503 = 0 THEN 90.0
       ELSE CAST(o.o_orderkey % 13 AS DOUBLE) END          AS hours,
  CASE WHEN o.o_orderkey % 83 = 0 THEN NULL
       ELSE CAST(1 + o.o_custkey % 5 AS DOUBLE) END        AS financial_stress,
  CASE WHEN c.c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS family_history,
  CASE WHEN (CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END)
          + (CASE WHEN o.o_orderkey % 13 >= 9 THEN 1 ELSE 0 END)
          + (CASE WHEN o.o_orderkey % 5 >= 3 THEN 1 ELSE 0 END)
          + (CASE WHEN o.o_totalprice > 400000 THEN 1 ELSE 0 END) >= 3
       THEN 1 ELSE 0 END                                   AS label
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""

# Fixed scores for the evaluation operators: 77 distinct scores, heavy ties,
# two models, no unique key.
SCORED_SQL = """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'model_a' ELSE 'model_b' END AS model,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       (CASE WHEN l_returnflag = 'R' THEN 0.3 ELSE 0.1 END)
         + CAST(floor(l_quantity) AS DOUBLE) / 100 AS score
FROM {lineitem}
"""

# Three member scores per id for ensembles, thresholds and output checks.
MEMBERS_SQL = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       CAST(o_orderkey % 101 AS DOUBLE) / 100 AS score_a,
       CAST(o_custkey % 101 AS DOUBLE) / 100 AS score_b,
       CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS DOUBLE) / 100 AS score_c
FROM {orders}
"""

_TABLES = {
    "cohort": (COHORT_SQL, ("orders", "customer", "nation")),
    "scored": (SCORED_SQL, ("lineitem",)),
    "members": (MEMBERS_SQL, ("orders",)),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, tables = _TABLES[name]
    return spark.sql(text, **{t: read_table(spark, sf_dir, t) for t in tables})


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "cohort")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "scored")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "members")


def fixture_sql(name: str) -> str:
    """The same text with plain table names, for the DuckDB oracle."""
    text, tables = _TABLES[name]
    return text.format(**{t: t for t in tables})
