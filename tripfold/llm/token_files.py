"""Token-id corpora as ORC: run-length encoded ids, row indexes, Bloom filters on document ids.

A corpus is a folder of ORC files, one or more shards each, in ascending document id over all
shards, plus a small manifest with the ids before every shard. ORC's stripes give parallel
reads within a file, its integer run-length encoding packs the ids, and a filter on ``doc_id``
skips stripes and row groups by their statistics and Bloom filters.

Every document is followed by an end id. Defined results:

* a null text is empty: the end id alone;
* null document ids come first; rows with equal ids are ordered by text, equal rows stay apart;
* an empty table makes an empty corpus; other columns are not stored.

Texts are dealt to shards by id ranges cut at quantiles of the ids and encoded as a stream, a
megabyte of text at a time, so memory is bounded by one Arrow batch and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripfold.llm.common import in_id_shards, small_batches

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 5000
DOCUMENTS_PER_SHARD = 8000

ROWS = "shard int, doc_id bigint, shard_start bigint, n_tokens bigint, ids array<int>"
_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("doc_id", pa.int64()),
        ("shard_start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """A list column of ids from their bytes."""
    sizes = np.fromiter((len(ids) // 4 for ids in encoded), dtype=np.int64, count=len(encoded))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def list_bytes(column: pa.ListArray) -> Iterator[bytes]:
    """The ids of every row as little-endian unsigned 32-bit integers."""
    values = column.values.to_numpy(zero_copy_only=False).view("<u4")
    offsets = column.offsets.to_numpy()
    for start, end in zip(offsets[:-1], offsets[1:]):
        yield values[start:end].tobytes()


# A slice of texts to encode: so many bytes, or one text if that is longer, and so many rows.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 500


def in_slices(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """Small slices by the bytes of a text column, so that the ids of a batch are never all in memory."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def write_corpus(
    documents: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    documents_per_shard: int = DOCUMENTS_PER_SHARD,
) -> None:
    """Encode all documents in ascending id order into ORC files under ``path``."""
    texts, shards = in_id_shards(documents, documents_per_shard)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tripfold.llm.tokens import encoder

        encode = encoder(tokenizer).encode
        shard, before = None, 0
        for batch in in_slices(batches):
            texts, numbers = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ids = [encode(text) + end for text in texts]
            starts = []
            for number, own in zip(numbers, ids):
                if number != shard:
                    shard, before = number, 0
                starts.append(before)
                before += len(own) // 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).cast(pa.int32()),
                    batch.column(0),
                    pa.array(starts, pa.int64()),
                    pa.array([len(own) // 4 for own in ids], pa.int64()),
                    id_lists(ids),
                ],
                schema=_ARROW,
            )

    rows = (
        texts.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(encoded, ROWS)
    )
    with small_batches(documents.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("compression", "zstd")
            .option("orc.stripe.size", STRIPE_BYTES)
            .option("orc.row.index.stride", ROW_INDEX_STRIDE)
            .option("orc.create.index", "true")
            .option("orc.bloom.filter.columns", "doc_id")
            .orc(f"{path}/documents")
        )
    stored = documents.sparkSession.read.schema(ROWS).orc(f"{path}/documents")
    # One row per shard: a table of document counts over documents_per_shard.
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("shard", "tokens", F.coalesce(before, F.lit(0)).alias("before")).coalesce(
        1
    ).write.mode("overwrite").orc(f"{path}/shards")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids of every document."""
    stored = spark.read.schema(ROWS).orc(f"{path}/documents")
    shards = spark.read.schema("shard int, tokens bigint, before bigint").orc(f"{path}/shards")
    # The planner compares the manifest's file size with its broadcast threshold.
    return stored.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids"
    )


def with_crc32(corpus: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned integers."""
    import zlib

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(ids) for ids in list_bytes(batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return corpus.mapInArrow(
        summed, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
