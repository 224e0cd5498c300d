"""Benchmark decontamination: test items found inside documents by MinHash containment.

An item with n distinct shingles is contained in a document at threshold t when the document
has at least need = ceil(t * n) of them. Items are partitioned by size, and the size fixes the
length k = n - need + 1 of an item's MinHash sketch (its k smallest shingle hashes): whichever
``need`` shingles a document holds, one of them is among those k, so looking the sketches up in
the documents misses no pair. Per partition, documents show only hashes up to the largest sketch
value of the partitions they are big enough for, about a quarter of them. Candidates are then
verified on the shingles themselves.

Words are maximal runs of letters and digits, lower-cased; shingles are five consecutive words. An
item of fewer words is one shingle of them all, and documents also show their shingles of the
lengths such items have, four lengths at most. Defined results:

* null or word-free texts, of documents or items, match nothing;
* rows with equal id and equal text are one document (or item); ids may be null or repeat;
* other columns are not looked at, whatever their names;
* empty tables give no rows.

The main path is DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import matched_rows, row_key, small_side, staged

SHINGLE_WORDS = 5
CONTAINMENT = 0.8


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, not once a lambda call."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles_of(text: Column, length: int = SHINGLE_WORDS, shorter: Sequence[int] = ()) -> Column:
    """Word shingles as strings, repeats included, and those of the ``shorter`` lengths.

    Fewer words make one shingle of them all, none for no words.
    """

    def build(words: Column) -> Column:
        def of(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
            return F.transform(starts, lambda start: F.array_join(F.slice(words, start, n), " "))

        none = F.array().cast("array<string>")
        own = (
            F.when(F.size(words) >= length, of(length))
            .when(F.size(words) > 0, F.array(F.array_join(words, " ")))
            .otherwise(none)
        )
        return F.concat(own, *(F.when(F.size(words) >= n, of(n)).otherwise(none) for n in shorter))

    return _once(words_of(text), build)


def shingle_hashes_of(text: Column, length: int = SHINGLE_WORDS, shorter: Sequence[int] = ()) -> Column:
    """A 64-bit hash per shingle, made from one hash per word."""

    def build(hashes: Column) -> Column:
        count = F.size(hashes)

        def of(n: int) -> Column:
            starts = F.sequence(F.lit(0), count - n)
            return F.transform(
                starts, lambda start: F.xxhash64(*(F.get(hashes, start + i) for i in range(n)))
            )

        none = F.array().cast("array<bigint>")
        own = F.when(count >= length, of(length))
        for n in range(1, length):
            short = F.array(F.xxhash64(*(F.get(hashes, F.lit(i)) for i in range(n))))
            own = own.when(count == n, short)
        return F.concat(
            own.otherwise(none), *(F.when(count >= n, of(n)).otherwise(none) for n in shorter)
        )

    return _once(F.transform(words_of(text), lambda word: F.xxhash64(word)), build)


def short_lengths(items: DataFrame, length: int = SHINGLE_WORDS) -> list[int]:
    """The word counts below ``length`` that occur among items, ascending."""
    words = F.size(words_of(F.col("text")))
    counts = items.select(words.alias("n")).where(F.col("n").between(1, length - 1)).distinct()
    return sorted(row.n for row in counts.collect())


def item_sketches(items: DataFrame, threshold: float) -> DataFrame:
    """item, size_class, need and sketch (the k smallest hashes), one row per item."""
    sizes = F.size("hashes")
    # a small slack keeps ceil right where t * n is a whole number that doubles miss
    need = F.greatest(F.lit(1), F.ceil(F.lit(threshold) * F.col("n") - 1e-9)).cast("int")
    return (
        items.select("item", F.array_sort(F.array_distinct(shingle_hashes_of(F.col("text")))).alias("hashes"))
        .where(sizes > 0)
        .withColumn("n", sizes)
        .withColumn("need", need)
        .select(
            "item",
            "need",
            F.floor(F.log2("n")).cast("int").alias("size_class"),
            F.slice("hashes", 1, F.col("n") - F.col("need") + 1).alias("sketch"),
        )
    )


def _identified(table: DataFrame, id_column: str, text_column: str, name: str) -> DataFrame:
    """Distinct (id, text) rows: a struct that identifies the row, and the text."""
    key = F.struct(F.col(id_column).alias("id"), row_key(text_column).alias("hash")).alias(name)
    return table.where(F.col(text_column).isNotNull()).select(key, F.col(text_column).alias("text"))


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    threshold: float = CONTAINMENT,
    document_id: str = "doc_id",
    item_id: str = "item_id",
) -> DataFrame:
    """Pairs of a document and an item it contains.

    Returns doc (struct of id and text hash), item (likewise), item_shingles, shared and
    containment = shared / item_shingles.
    """
    docs = _identified(documents, document_id, "text", "doc")
    tests = staged(
        _identified(items, item_id, "text", "item")
        .dropDuplicates(["item"]),
        "benchmark-items",
    )
    sketches = staged(item_sketches(tests, threshold), "benchmark-sketches")
    shorter = short_lengths(tests)
    # One row per size class, 31 at most.
    classes = sketches.groupBy("size_class").agg(
        F.max(F.array_max("sketch")).alias("highest"), F.min("need").alias("least")
    ).collect()
    if not classes:
        highest = F.lit(None).cast("bigint")
    else:
        highest = F.greatest(
            *(F.when(F.col("size") >= row.least, F.lit(row.highest)) for row in classes),
            F.lit(None).cast("bigint"),
        )
    lookup = small_side(
        staged(sketches.select("item", "need", F.explode("sketch").alias("hash")), "sketch-values")
    )
    shown = (
        docs.select("doc", F.array_distinct(shingle_hashes_of(F.col("text"), shorter=shorter)).alias("hashes"))
        .withColumn("size", F.size("hashes"))
        .withColumn("highest", highest)
        .select(
            "doc", "size", F.explode(F.expr("filter(hashes, h -> h <= highest)")).alias("hash")
        )
    )
    candidates = staged(
        shown.join(lookup, "hash").where(F.col("size") >= F.col("need")).select("doc", "item").distinct(),
        "contamination-candidates",
    )
    return _verified(docs, tests, candidates, threshold, shorter)


def _verified(
    docs: DataFrame, tests: DataFrame, candidates: DataFrame, threshold: float, shorter: Sequence[int]
) -> DataFrame:
    """Candidates at or above the threshold, counted on the shingles themselves."""
    item_shingles = staged(
        tests.select("item", F.array_distinct(shingles_of(F.col("text"))).alias("all"))
        .select("item", F.size("all").alias("item_shingles"), F.explode("all").alias("shingle")),
        "benchmark-shingles",
    )
    suspects = small_side(candidates.select("doc").distinct())
    # Semi join first: only suspected documents are cut into shingles again.
    # All shingles of a document stay in one row until they meet the items, so that they are distinct.
    doc_shingles = docs.join(suspects, "doc", "left_semi").select(
        "doc", F.explode(F.array_distinct(shingles_of(F.col("text"), shorter=shorter))).alias("shingle")
    )
    hits = (
        doc_shingles.join(small_side(item_shingles), "shingle")
        .groupBy("doc", "item", "item_shingles")
        # rows that repeat whole must not count twice
        .agg(F.count_distinct("shingle").alias("shared"))
    )
    need = F.ceil(F.lit(threshold) * F.col("item_shingles") - 1e-9)
    return (
        hits.where(F.col("shared") >= need)
        .join(candidates, ["doc", "item"], "left_semi")
        .select(
            "doc",
            "item",
            F.col("item_shingles").cast("bigint"),
            "shared",
            (F.col("shared") / F.col("item_shingles")).alias("containment"),
        )
    )


def without_contaminated(
    documents: DataFrame, items: DataFrame, threshold: float = CONTAINMENT
) -> DataFrame:
    """The documents, all columns, that contain no item. Null texts stay."""
    pairs = contained_items(documents, items, threshold)
    found = staged(pairs.select(F.col("doc.id").alias("doc_id"), "doc.hash").distinct(), "contaminated")
    return matched_rows(documents, found, "left_anti")
