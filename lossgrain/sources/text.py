"""Headerless, separator-delimited loan files."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lossgrain import constants as K

log = logging.getLogger(__name__)

ORIGINATION_GLOB = "historical_data_*.txt"
PERFORMANCE_GLOB = "historical_data_time_*.txt"
CORRUPT = "_corrupt"
POSITION = ("_file", "_block", "_row")


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def discover(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """Files that match, by name: ``file_name, path, length``.

    A directory that does not exist or holds no such file gives no row and a
    warning.
    """
    try:
        found = (
            spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "file_name string, path string, length bigint")
    if found.isEmpty():
        log.warning("no file matches %s in %s", glob, directory)
    return found.orderBy("file_name")


def empty(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    positions = T.StructType(
        [
            T.StructField("_file", T.StringType()),
            T.StructField("_block", T.LongType()),
            T.StructField("_row", T.LongType()),
        ]
    )
    fields = [*text_schema([*columns, CORRUPT]).fields, *positions.fields]
    return spark.createDataFrame([], T.StructType(fields))


def read_lines(spark: SparkSession, directory: str, columns: Sequence[str], glob: str) -> DataFrame:
    """All rows of the matching files as text, plus position and raw bad rows.

    Every field is a string; the usual missing tokens become null. The file
    name, the offset of the file part and a counter inside it give the order
    of the rows, and are taken before anything is shuffled.
    """
    if discover(spark, directory, glob).isEmpty():
        return empty(spark, columns)
    rows = (
        spark.read.schema(text_schema([*columns, CORRUPT]))
        .option("sep", "|")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .option("pathGlobFilter", glob)
        .csv(directory)
    )
    cleaned = [F.when(~F.col(c).isin(K.NA_TOKENS), F.col(c)).alias(c) for c in columns]
    return rows.select(
        *cleaned,
        CORRUPT,
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def too_long(rows: DataFrame, n_columns: int) -> Column:
    """Whether a row has more fields than the layout; separators inside a quoted field do not count."""
    plain = F.regexp_replace(CORRUPT, r'(^|\|)"(?:[^"]|"")*"', "$1")
    separators = F.length(plain) - F.length(F.replace(plain, F.lit("|"), F.lit("")))
    # Spark refuses to scan for raw bad lines alone, so a data column takes part.
    scanned = F.coalesce(F.length(F.col(rows.columns[0])), F.lit(0)) >= 0
    return F.coalesce(separators >= n_columns, F.lit(False)) & scanned


def split_rejects(rows: DataFrame, n_columns: int) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, and rows with too many fields as raw text.

    A row with too few fields is kept, padded with null.
    """
    bad = too_long(rows, n_columns)
    rejects = rows.where(bad).select("_file", F.col(CORRUPT).alias("line"))
    return rows.where(~bad).drop(CORRUPT), rejects


def read_delimited(
    spark: SparkSession,
    directory: str,
    columns: Sequence[str],
    glob: str,
    with_position: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """The good rows of the matching files.

    ``observation`` receives the number of rows read and rejected when the
    result is computed, without another scan.
    """
    rows = read_lines(spark, directory, columns, glob)
    if observation is not None:
        rejected = F.count_if(too_long(rows, len(columns))).alias("rejected")
        rows = rows.observe(observation, F.count("*").alias("read"), rejected)
    good, _ = split_rejects(rows, len(columns))
    return good if with_position else good.drop(*POSITION)


def write_delimited(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write columns by position in the same text format; null is empty."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    df.select(F.concat_ws("|", *text).alias("value")).write.mode("overwrite").text(path)
