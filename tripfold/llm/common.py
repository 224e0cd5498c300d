"""What several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.sources.staging import materialised, new_folder

# A side is broadcast only when counting proves it to have at most so many rows.
BROADCAST_ROWS = 500_000


_HELD: dict[str, object] = {}


def held_by_worker(name: str, make):
    """What a Python worker keeps between tasks under a name, made when it is first asked for.

    A worker outlives the stages it serves; asking for another name lets go of the last.
    """
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Return memory that a worker has freed to the system: earlier stages leave much of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    return materialised(frame, new_folder(frame.sparkSession, purpose))


# A task that encodes texts holds an Arrow batch of them on both sides of the pipe.
TEXTS_PER_BATCH = 1000
ROW_GROUP_BYTES = 16 << 20


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXTS_PER_BATCH) -> Iterator[None]:
    """Arrow batches of so many rows for the jobs that run inside; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged_texts(frame: DataFrame, purpose: str) -> DataFrame:
    """``staged`` for wide rows made in Python: small batches in, small row groups out."""
    path = new_folder(frame.sparkSession, purpose)
    with small_batches(frame.sparkSession):
        frame.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``limit`` rows, else as it is.

    Call it on staged frames: it counts them.
    """
    few = frame.limit(limit + 1).count() <= limit
    return F.broadcast(frame) if few else frame


def fresh_name(frame: DataFrame, base: str) -> str:
    """A column name the frame does not have, whatever case its names are in."""
    taken = {name.lower() for name in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base


def whole_text(column: str = "text") -> Column:
    """The text; a null one is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def matched_rows(documents: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of documents with (doc_id, hash of text) rows.

    The keys go in as one struct under a name the documents do not have; null ids match.
    """
    name = fresh_name(documents, "row_key")
    wanted = keys.select(F.struct("doc_id", "hash").alias(name))
    own = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("hash"))
    return documents.join(small_side(wanted), own.eqNullSafe(F.col(name)), how)


def row_key(text: str = "text") -> Column:
    """Tells rows of one document id apart by their text; equal rows share it."""
    return F.xxhash64(F.col(text))


# Beyond so many shards they grow instead: their cuts are part of the plan.
MOST_SHARDS = 4096


def in_id_shards(documents: DataFrame, rows_per_shard: int) -> tuple[DataFrame, int]:
    """doc_id, text (null: empty) and shard, and how many shards there may be.

    Shards are ranges of ids, ascending, cut at approximate quantiles; null ids are in the first.
    Rows of one id share a shard. The quantiles read the id column alone.
    """
    rows = documents.count()
    count = min(MOST_SHARDS, max(1, -(-rows // rows_per_shard)))
    ids = documents.select(F.col("doc_id").cast("bigint").alias("id")).where("id IS NOT NULL")
    steps = [i / count for i in range(1, count)]
    cuts = sorted({int(cut) for cut in ids.approxQuantile("id", steps, 0.2 / count)}) if steps else []
    held = F.array(*(F.lit(cut).cast("bigint") for cut in cuts)) if cuts else None
    place = F.lit(0)
    if cuts:
        below = F.size(F.filter(held, lambda cut: cut < F.col("doc_id")))
        place = F.when(F.col("doc_id").isNull(), 0).otherwise(below)
    frame = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return frame.withColumn("shard", place.cast("int")), len(cuts) + 1
