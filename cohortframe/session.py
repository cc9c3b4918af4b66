"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "cohortframe", master: str | None = None,
                shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the input (roughly
    input bytes / 128 MB), AQE coalesces the small ones at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and tasks share one process, and so one disk."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    and all tasks run on this machine (unit tests, a laptop) is a private
    scratch folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cohortframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used after iterative or expensive stages so a lost executor recomputes
    from the checkpoint instead of from the raw scan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Bytes of a method beyond which the JVM does not compile it, and the setting by which Spark then projects in split methods instead.
COMPILED_BYTES, METHOD_LIMIT = 8000, "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside keeps no whole-stage method that the JVM would interpret: wide projections of nested
    conditions outgrow its limit and take several times longer for each row.  Only actions inside count."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stage tables."""
    return os.path.join(checkpoint_dir(spark), "stages", name)


def mounted(path: str) -> str | None:
    """A path that tasks can open as a file, or None (an object store, say)."""
    from urllib.parse import unquote, urlparse
    at = urlparse(path)
    if at.scheme == "file":
        return unquote(at.path)
    return path if not at.scheme and path.startswith("/") else None
