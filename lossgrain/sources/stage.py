"""Stage tables between the steps, macro series and the drift baseline."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lossgrain.sources import commits as cm


#: Snapshots that stay for readers which have begun with them, the newest included.
SNAPSHOTS = 3


def stage(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, keep: int = SNAPSHOTS) -> int:
    """Replace the table at ``path``; returns the number of the new snapshot.

    Rows are written to a folder of their own, which becomes the table only
    when it is complete: a write that fails leaves the table as it was, a
    reader keeps the snapshot it has begun with, and ``df`` may read the table
    itself. All but the last ``keep`` snapshots are deleted afterwards.

    With ``partition_by`` rows are rebalanced by those columns first: a task
    writes few of the partitions, and a large partition is split by its size.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    rows = df.hint("rebalance", *columns) if columns else df
    (rows.write.partitionBy(*columns) if columns else rows.write).parquet(f"{path}/data/{token}")
    version = cm.latest(spark, path) + 1
    while not cm.claim(spark, path, version, token, base=True):
        version += 1
    for old in cm.all_commits(spark, path)[:-max(keep, 1)]:
        cm.delete(spark, f"{path}/data/{old.token}")
    return version


def load_stage(
    spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame:
    """The newest snapshot of the table at ``path`` (or a kept one, by number), or an error that names where it was expected.

    A plain folder of Parquet files is read as it is. A partitioned table
    without rows has no file to take the columns from, hence the optional
    ``schema``.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = cm.commits(spark, path) if version is None else [c for c in cm.all_commits(spark, path) if c.version == version]
    place = f"{path}/data/{found[-1].token}" if found else path
    try:
        if version is not None and not found:
            raise FileNotFoundError(f"snapshot {version} of the stage table not found, expected at: {path}")
        return reader.parquet(place)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"stage table not found, expected at: {path}") from error


def read_macro_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A macro series with a header line and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def training_means(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, train_mean`` of the training rows."""
    row = df.agg(*[F.avg(c).alias(c) for c in features])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("train_mean")) for c in features])
    return row.select(F.inline(pairs))


def save_training_means(df: DataFrame, features: Sequence[str], path: str) -> None:
    stage(training_means(df, features), path)


def load_training_means(spark: SparkSession, path: str) -> DataFrame:
    return load_stage(spark, path)
