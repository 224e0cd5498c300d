"""Packing documents into sequences: shortest pack first over the length histogram.

Documents longer than a sequence are cut into full sequences and a rest. The rests are packed by
their length histogram alone, which has at most ``length`` bins whatever the corpus: lengths are
placed longest first, each into the shortest open pack, updating the counts of packing patterns;
a pattern stands for as many equal sequences as its count says.
Patterns are then joined back to the documents by rank: the i-th rest of a length takes the i-th
slot of that length. Ranks are counted per task and length while encoding, and made global by
sums over tasks, so no length is ever gathered in one place.

Defined results: a null text is empty (the end id alone); repeated ids and rows are packed each
on their own; an empty table gives no pieces; other columns are not looked at. Which sequence a
piece lands in depends on the layout of the input files, the padding does not.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfold.llm.common import small_side, staged, staged_texts, whole_text
from tripfold.llm.token_files import id_lists, in_slices

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
LENGTH = 1024

PIECES = (
    "doc_id bigint, start bigint, length int, doc_tokens bigint, task int, "
    "place bigint, ids array<int>"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int32()),
        ("doc_tokens", pa.int64()),
        ("task", pa.int32()),
        ("place", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) with their counts; every document is in one.

    Lengths go longest first to the pattern with the most room that can take them, i.e. the
    shortest pack; a new pattern opens when none can. Counts are moved, not single documents.
    """
    open_packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by room left
    for size in sorted((n for n in histogram if histogram[n]), reverse=True):
        left = histogram[size]
        while left:
            # A pack takes a length at most once a round, then is as short as its new room says.
            room = max((r for r, packs in open_packs.items() if packs and r >= size), default=None)
            if room is None:
                # New packs: as many whole ones as the length fills, the rest in one more.
                each = length // size
                full, rest = divmod(left, each)
                for lengths, count in (((size,) * each, full), ((size,) * rest, 1 if rest else 0)):
                    if count:
                        packs = open_packs[length - sum(lengths)]
                        packs[lengths] = packs.get(lengths, 0) + count
                break
            pattern, count = open_packs[room].popitem()
            take = min(count, left)
            if count > take:
                open_packs[room][pattern] = count - take
            packs = open_packs[room - size]
            packs[(*pattern, size)] = packs.get((*pattern, size), 0) + take
            left -= take
    return [
        (pattern, count)
        for room in sorted(open_packs)
        for pattern, count in sorted(open_packs[room].items())
        if count
    ]


def slots_of(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset): where ranks of a length go."""
    rank: dict[int, int] = defaultdict(int)
    slots, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            slots.append((size, rank[size], count, sequence, offset))
            rank[size] += count
            offset += size
        sequence += count
    return slots


def cut_pieces(
    documents: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, length: int = LENGTH
) -> DataFrame:
    """Pieces of at most ``length`` ids with the task that made them and their place in it.

    ``place`` counts pieces of the same length within the task. Stage the result before use: a
    task that runs again may see its rows in another order.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tripfold.llm.tokens import encoder

        encode = encoder(tokenizer).encode
        task = TaskContext.get().partitionId()
        places = [0] * (length + 1)
        for batch in in_slices(batches):
            columns: list[list] = [[], [], [], [], []]
            pieces = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                tokens = len(ids) // 4
                for start in range(0, tokens, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    size = len(piece) // 4
                    for column, value in zip(columns, (doc_id, start, size, tokens, places[size])):
                        column.append(value)
                    places[size] += 1
                    pieces.append(piece)
            doc_ids, starts, sizes, tokens, place = columns
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(tokens, pa.int64()),
                    pa.array([task] * len(sizes), pa.int32()),
                    pa.array(place, pa.int64()),
                    id_lists(pieces),
                ],
                schema=_ARROW,
            )

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
    ).mapInArrow(encoded, PIECES)


def pack(
    documents: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, length: int = LENGTH
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids."""
    spark = documents.sparkSession
    pieces = staged_texts(cut_pieces(documents, tokenizer, end_id, length), "pieces")
    counts = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    # At most ``length`` rows.
    histogram = {
        row["length"]: row["n"]
        for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    slots = slots_of(shortest_pack_first(histogram, length))
    earlier = F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per task: the rank at which its pieces of every length begin.
    firsts = small_side(
        staged(
            counts.withColumn("first", F.coalesce(earlier, F.lit(0)))
            .groupBy("task")
            .agg(F.map_from_entries(F.collect_list(F.struct("length", "first"))).alias("firsts")),
            "piece-ranks",
        ),
        limit=2000,
    )
    # The table of slots is bounded by the bins of the histogram, not by the corpus.
    table = spark.createDataFrame(
        slots or [(0, 0, 0, 0, 0)], "length int, rank bigint, n bigint, sequence bigint, offset bigint"
    ).where("n > 0")
    table = table.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("rank", "sequence", "offset"))).alias("slots")
    )
    ranked = pieces.join(firsts, "task").withColumn(
        "rank", F.col("place") + F.element_at("firsts", F.col("length"))
    )
    slot = F.element_at(F.filter("slots", lambda s: s["rank"] <= F.col("rank")), -1)
    return (
        ranked.join(F.broadcast(table), "length")
        .withColumn("slot", slot)
        .select(
            "doc_id",
            "start",
            F.col("length").cast("bigint").alias("length"),
            "doc_tokens",
            (F.col("slot.sequence") + F.col("rank") - F.col("slot.rank")).alias("sequence_id"),
            F.col("slot.offset").alias("offset"),
            "ids",
        )
    )


def with_crc32(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    import zlib

    from tripfold.llm.token_files import list_bytes

    columns = packed.columns
    place = columns.index("ids")
    names = ["ids_crc32" if name == "ids" else name for name in columns]
    kinds = ", ".join(f"{name} bigint" for name in names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.array([zlib.crc32(ids) for ids in list_bytes(batch.column(place))], pa.int64())
            arrays = [sums if i == place else array for i, array in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return packed.mapInArrow(summed, kinds)
