"""Session helpers: a local session for tests and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows that a task groups, sorts or joins where rows are dealt by their number.
ROWS = 400_000


def local_session(cpus: int | None = None, app: str = "sitewise", **conf: str) -> SparkSession:
    """Build a local session; a cluster submits with its own configuration instead."""
    n = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder would lose rows on a cluster, so a missing setting is an error;
    ``local_session`` sets one.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="sitewise-ckpt-")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


def dealt(df: DataFrame, *keys: str, rows: int | None = None, each: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` into tasks of about ``each`` rows, ``ROWS`` if not given.

    What follows on these keys runs in the same tasks, so what one of them holds does not grow
    with the input.  ``rows`` spares the count where the caller knows the number or more.
    """
    rows = df.count() if rows is None else rows
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // (each or ROWS))), *keys)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written as parquet in the shared checkpoint folder and read again.

    For many rows: columns are packed and only those asked for are read, where a checkpoint holds
    whole rows as they are in memory.  Partitions are not kept.
    """
    folder = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
