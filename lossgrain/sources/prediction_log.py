"""Append-only prediction log in which the first write of an id wins.

The rows of an append lie below ``data/token=.../day=...``, by the day of
their time. Beside them ``manifest`` has, for each such partition, the number
of its rows, the smallest and largest id and Bloom filters of the ids (one
for every million or so). An append compares its ids only with the
partitions whose range and filter may hold one of them. Appends are commits:
of two writers that log one id at a time, the one that commits second sees
the other's rows and leaves the id out.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrain.operators.resolve import dedupe_first
from lossgrain.session import pin
from lossgrain.sources import commits as cm

LOG_SCHEMA = (
    "prediction_id string, ts timestamp, features_json string, "
    "predicted_lgd double, model_version string"
)
LOG_COLUMNS = ["prediction_id", "ts", "features_json", "predicted_lgd", "model_version"]
MANIFEST_SCHEMA = (
    "token string, day string, n bigint, min_id string, max_id string, "
    "slices int, slice int, n_slice bigint, bits binary"
)
NO_DAY = "none"
#: Ids of one Bloom filter, bits for each of them, and bits that an id sets.
FILTER_IDS, ID_BITS, PROBES = 1 << 20, 24, 10
#: New ids up to which filters are asked; 8 bytes each are sent to the tasks.
ASKED_IDS = 4 << 20
#: Times an append starts again because others committed first.
ATTEMPTS = 100


def new_predictions(existing: DataFrame, new: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` whose id is not logged yet, one per id.

    Repeats inside ``new`` are reduced before the shuffle, so that the anti
    join meets every id once.
    """
    order = order or ["ts", "features_json", "predicted_lgd", "model_version"]
    return dedupe_first(new, "prediction_id", order).join(
        existing.select("prediction_id"), "prediction_id", "left_anti"
    )


# --- Bloom filters of ids -------------------------------------------------

def _spots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each 64-bit hash: two of its halves, combined ``PROBES`` times."""
    h = hashes.astype(np.uint64)
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(one + np.uint64(i) * two) % np.uint64(bits) for i in range(PROBES)]).astype(np.int64)


def _filter_of(hashes: np.ndarray) -> bytes:
    bits = max(64, len(hashes) * ID_BITS) // 8 * 8
    out, spots = np.zeros(bits // 8, np.uint8), _spots(hashes, bits).ravel()
    np.bitwise_or.at(out, spots >> 3, (1 << (spots & 7)).astype(np.uint8))
    return out.tobytes()


def _may_hold(data: bytes, hashes: np.ndarray) -> bool:
    bits = np.frombuffer(data, np.uint8)
    spots = _spots(hashes, len(bits) * 8)
    return bool(((bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).all(axis=0).any())


def _id_hash() -> Column:
    return F.xxhash64("prediction_id")


def manifest_rows(rows: DataFrame, token: str) -> DataFrame:
    """One manifest row per day and slice of ids of ``rows``, which have a ``day``."""
    per_day = rows.groupBy("day").agg(
        F.count("*").alias("n"), F.min("prediction_id").alias("min_id"), F.max("prediction_id").alias("max_id"))
    sliced = per_day.withColumn("slices", F.ceil(F.col("n") / F.lit(FILTER_IDS)).cast("int"))
    # A handful of numbers a day; ids meet their day's by an equality join.
    ids = rows.select("day", _id_hash().alias("hash")).join(sliced, "day").withColumn(
        "slice", F.pmod("hash", F.col("slices").cast("long")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        hashes = table.column("hash").to_numpy()
        first = table.slice(0, 1).drop_columns(["hash"])
        return first.append_column("n_slice", pa.array([len(hashes)], pa.int64())).append_column(
            "bits", pa.array([_filter_of(hashes)], pa.binary()))

    made = ids.groupBy("day", "slice").applyInArrow(
        build, "day string, n bigint, min_id string, max_id string, slices int, slice int, n_slice bigint, bits binary")
    return made.select(F.lit(token).alias("token"), *[c.split()[0] for c in MANIFEST_SCHEMA.split(", ")[1:]])


# --- reading --------------------------------------------------------------

def manifest(spark: SparkSession, path: str, found: list[cm.Commit]) -> DataFrame:
    """Manifest rows of the given commits."""
    places = [f"{path}/manifest/{c.token}" for c in found]
    return spark.read.schema(MANIFEST_SCHEMA).parquet(*places) if places else spark.createDataFrame([], MANIFEST_SCHEMA)


def partitions_for(spark: SparkSession, path: str, new: DataFrame, found: list[cm.Commit]) -> list[str]:
    """Folders of the commits that may hold an id of ``new``; names of folders reach the driver, no ids' rows."""
    span = new.agg(F.min("prediction_id"), F.max("prediction_id"), F.count("prediction_id")).first()
    if not found or not span[2]:
        return []
    near = manifest(spark, path, found).where((F.col("max_id") >= span[0]) & (F.col("min_id") <= span[1]))
    if span[2] > ASKED_IDS:  # so many that every filter would say yes
        hit = near.select("token", "day").distinct()
    else:
        hashes = new.where("prediction_id is not null").select(_id_hash().alias("h")).toArrow().column("h").to_numpy()
        asked = spark.sparkContext.broadcast(hashes)

        def ask(batches):
            for batch in batches:
                token, day, slices, own, bits = (batch.column(i).to_pylist() for i in range(5))
                kept = [i for i in range(batch.num_rows)
                        if _may_hold(bits[i], asked.value[np.mod(asked.value, slices[i]) == own[i]])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for i in kept], pa.string()) for x in (token, day)], ["token", "day"])

        hit = near.select("token", "day", "slices", "slice", "bits").mapInArrow(ask, "token string, day string").distinct()
    return sorted(f"{path}/data/token={r.token}/day={r.day}" for r in hit.collect())


def _rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(*folders).select(*LOG_COLUMNS)


def read_predictions(spark: SparkSession, path: str, days: tuple[str, str] | None = None) -> DataFrame:
    """The whole log, or the days (``yyyy-MM-dd``) from the first to the second of ``days``; empty before the first append."""
    return appended(spark, path, [f"{path}/data/token={c.token}" for c in cm.commits(spark, path)], days)


def appended(spark: SparkSession, path: str, folders: list[str], days: tuple[str, str] | None = None) -> DataFrame:
    """The rows of some appends of the log at ``path``, given by their folders."""
    if not folders:
        return spark.createDataFrame([], LOG_SCHEMA)
    table = spark.read.schema(f"{LOG_SCHEMA}, token string, day string").option("basePath", f"{path}/data").parquet(*folders)
    return (table if days is None else table.where(F.col("day").between(*days))).select(*LOG_COLUMNS)


# --- writing --------------------------------------------------------------

def append_predictions(spark: SparkSession, path: str, new: DataFrame, batch: str | None = None) -> int | None:
    """Add unseen predictions to the log at ``path``; returns the number of the commit, None if nothing was new.

    With ``batch`` (the name of a micro-batch, say) a second append of the
    same name adds nothing either.
    """
    order = ["ts", "features_json", "predicted_lgd", "model_version"]
    rows = pin(dedupe_first(new.select(*LOG_COLUMNS), "prediction_id", order))
    compared = 0
    for _ in range(ATTEMPTS):
        seen = cm.latest(spark, path)
        found = cm.commits(spark, path, compared) if compared else cm.commits(spark, path)
        if batch is not None and _has_batch(spark, path, batch):
            return None
        if any(c.base for c in found) and compared:
            found = cm.commits(spark, path)  # rewritten meanwhile: compare with all of it
        fresh = rows.join(
            _rows(spark, partitions_for(spark, path, rows, found)).select("prediction_id"), "prediction_id", "left_anti")
        rows = pin(fresh) if found else rows
        compared = seen
        if batch is None and rows.isEmpty():
            return None
        if _publish(spark, path, rows, seen + 1, note=batch or ""):
            return seen + 1
    raise RuntimeError(f"other writers committed first {ATTEMPTS} times: {path}")


def _has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    return any(batch in c.note.split("\n") for c in cm.commits(spark, path))


def _publish(spark: SparkSession, path: str, rows: DataFrame, version: int, base: bool = False, note: str = "") -> bool:
    """Write the rows and their manifest below a fresh token, and claim ``version`` for them."""
    token = uuid.uuid4().hex
    dated = rows.withColumn("day", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit(NO_DAY)))
    data, listed = f"{path}/data/token={token}", f"{path}/manifest/{token}"
    dated.hint("rebalance", "day").write.partitionBy("day").parquet(data)
    manifest_rows(dated, token).write.parquet(listed)
    if cm.claim(spark, path, version, token, base, note):
        return True
    for place in (data, listed):
        cm.delete(spark, place)
    return False


def compact_log(spark: SparkSession, path: str) -> int | None:
    """Rewrite the commits as one, with few files a day; None if another writer committed meanwhile.

    Earlier files stay for readers that have begun with them.
    """
    found = cm.commits(spark, path)
    if not found:
        return None
    version = found[-1].version + 1
    batches = "\n".join(c.note for c in found if c.note)
    return version if _publish(spark, path, read_predictions(spark, path), version, base=True, note=batches) else None


def to_log(scored: DataFrame, features: list[str], ts=None) -> DataFrame:
    """Scored rows in log form, with the input features as JSON."""
    payload = F.to_json(F.struct(*features), {"ignoreNullFields": "false"})
    return scored.select(
        "prediction_id",
        (F.current_timestamp() if ts is None else ts).alias("ts"),
        payload.alias("features_json"),
        F.col("lgd").alias("predicted_lgd"),
        "model_version",
    )
