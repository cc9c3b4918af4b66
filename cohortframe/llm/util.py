"""Helpers shared by the operators: stage tables, free column names, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.session import scratch_path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: after a lost executor the rows are read again, not computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, which bounds what a worker holds of long texts in Python."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each changed until no column of ``df`` has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: Keys that may be broadcast: some 40 MB of rows; more are joined by shuffle.
BROADCAST_KEYS = 400_000


def join_keys(rows: DataFrame, keys: DataFrame, on: Column, how: str) -> DataFrame:
    """Semi or anti join of wide rows with a table of short keys, broadcast when counted to be few.

    ``keys`` is read twice, so it should be a stage table.
    """
    few = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on, how)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Rows ``(u, root)`` for every vertex of ``edges(u, v)`` but the roots themselves.

    ``root`` is the smallest vertex of the component.  Alternating large-star and small-star
    rounds: neighbours move to the smallest one seen, so depth shrinks geometrically.  Each round
    is a pre-aggregated minimum and a join that the adaptive planner may split on hot
    vertices; its edges are written to the shared folder, and the loop ends when a round leaves
    them as they were.  No vertex or edge is sent to the driver.
    """
    edges = stage_table(edges.select("u", "v").filter("u <> v").distinct(), name)
    seen = None
    for _ in range(max_rounds):
        edges = stage_table(_small_star(_large_star(edges)), name)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            return edges.select("u", F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
