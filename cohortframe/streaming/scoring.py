"""Scoring new data as it arrives (entry point "score new data").

Applying fitted parameter tables is a stateless projection, so the same
``transform`` used in batch runs unchanged on a streaming DataFrame: new
files in a folder are read with ``readStream``, prepared with the stored
parameters, scored, and written by ``foreachBatch`` (idempotent per batch
id) to a sink folder.  The checkpoint lives under the shared checkpoint
folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortframe.session import checkpoint_dir


def read_new_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                   max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.format(fmt).schema(schema)
                 .option("maxFilesPerTrigger", max_files_per_trigger).load(folder))


def score_stream(spark: SparkSession, folder: str, schema: T.StructType,
                 transform: Callable[[DataFrame], DataFrame], sink: str, name: str = "scoring",
                 fmt: str = "parquet", once: bool = True):
    """Start the scoring stream; ``transform`` maps raw rows to the output
    rows (for example ``apply_impute -> encode -> features -> model``)."""
    stream = read_new_files(spark, folder, schema, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    w = (stream.writeStream.foreachBatch(write).queryName(name)
               .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "streams", name)))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
