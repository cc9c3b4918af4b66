"""Registered queries against their DuckDB oracle on sf0.001 (a fast sample;
scripts/check_oracle.py runs the full set at sf0.01), and the entry smoke."""

import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as entry
from cohortframe.sources.tables import TABLES
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"
SAMPLE = ["impute_apply", "profile_describe", "profile_correlation", "clean_sparse_rows", "split_stratified",
          "encode_label_unseen", "encode_target_oof", "feat_all", "scale_robust", "eval_all", "eval_roc",
          "thr_best", "validate_output", "cohort_compare"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stream_scoring(spark):
    from pyspark.sql import functions as F
    from cohortframe.sources import fixtures as fx
    from cohortframe.streaming.scoring import score_stream
    src = tempfile.mkdtemp(prefix="cf-stream-src-")
    sink = tempfile.mkdtemp(prefix="cf-stream-out-")
    m = fx.members(spark, SF)
    m.write.mode("overwrite").parquet(os.path.join(src, "part1"))
    q = score_stream(spark, os.path.join(src, "part1"), m.schema,
                     lambda b: b.select("id", ((F.col("score_a") + F.col("score_b") + F.col("score_c")) / 3 >= 0.5)
                                        .cast("int").alias("label")), sink, name=f"t{os.getpid()}")
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == m.count()
