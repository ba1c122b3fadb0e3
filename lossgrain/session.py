"""Session defaults and the shared folder that cuts lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "lossgrain", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting it is a folder below the warehouse, which a cluster
    points at shared storage.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lossgrain-shared"
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Tables of this process that :func:`release` may delete.
_PINNED: list[str] = []


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a columnar table in the shared folder.

    Later reads prune columns, know the size of the table, and survive the
    loss of the executors that wrote it.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    _PINNED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(table: DataFrame) -> int:
    """Size of the files of a pinned table, as the optimizer sees it."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def release(spark: SparkSession) -> None:
    """Delete the pinned tables, once nothing that reads them is wanted any more."""
    while _PINNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_PINNED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
