"""Sources and sinks.

* A1 header CSV scan with an explicit schema and NaN -> NULL.
* A2 stage tables: one parquet dataset per pipeline stage, partitioned by
  ``split`` so a later stage reads only the partition it needs.
* A3 parameter tables written as parquet (or JSON) by ``df.write``.
* A5 / A6 result and submission CSV sinks.

Model persistence (A4) lives in :mod:`cohortframe.operators.models`.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortframe.functions.columns import clean_doubles

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             **options) -> DataFrame:
    """A1: header CSV.  Pass a schema on large inputs (inference is a full
    extra pass); the literal ``NaN`` and empty fields become NULL."""
    r = spark.read.option("header", "true").option("nanValue", "NaN").option("nullValue", "")
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return clean_doubles(r.csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: result table as header CSV (one folder of part files)."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_submission(df: DataFrame, path: str, id_col: str = "id",
                     pred_col: str = "prediction", out_name: str = "label") -> None:
    """Two-column submission file."""
    write_csv(df.select(id_col, df[pred_col].cast("int").alias(out_name)), path)


def write_stage(df: DataFrame, path: str, split_col: str | None = "split",
                mode: str = "overwrite") -> None:
    """A2: write a stage table; column names travel in the parquet schema."""
    w = df.write.mode(mode)
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str, split: str | None = None,
               split_col: str = "split") -> DataFrame:
    """A2: read a stage table back; ``split`` prunes partitions."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(df[split_col] == split)
    return df


def write_params(params: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A3: parameter / settings table sink."""
    params.write.mode("overwrite").format(fmt).save(path)


def read_params(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
