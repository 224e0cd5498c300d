"""Filter interaction audit: what each filter removes in every order, and its fair share of it.

Five filters look at a document; a text they fail is removed by the first of them in the order of
application. Which filters a document fails does not depend on the order, so per part of the corpus
(a source) the documents are counted by the set of filters they fail, at most 32 counts. From these
the removals of all 32 coalitions of filters are tabulated: a coalition removes what fails one of
its members. A step of an order removes the difference of two coalitions. The Shapley value of a
filter is the solution of a least squares problem, exactly: the removals of the proper coalitions,
weighted by the Shapley kernel, are fitted by sums of one value a filter, under the constraint that
all values together are the removals of all filters; its normal equations are solved in rationals.

Spark counts; a task sees one row of counts a part, whatever the size of the part. Identical texts
are found by their SHA-256: the least id of each is aggregated and joined back on hash and id
together, a key that even the most frequent text has on one row only.

Defined results: a null text is empty, with no words and no code points; it fails A alone, and E.
Documents without an id never fail E and have no labels; rows with the same id and text are none
of them "identical to a smaller id". Repeated rows count each; repeated labels of an id count as
one that has what any has. A null source and an empty one are one part. An empty table has no
parts. Only ``doc_id``, ``text`` and ``source`` are looked at, so other columns can not clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import staged, whole_text

FILTERS = "ABCDE"
BIT = {name: 1 << place for place, name in enumerate(FILTERS)}
ALL = (1 << len(FILTERS)) - 1

# The limits of the filters.
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
SYMBOLS = "[#$%&*|]"
BLANKS = "[\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RESULT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, BLANKS), "")
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    tests = {
        "A": F.size(words) < LEAST_WORDS,
        "B": distinct * 100 < F.size(words) * LEAST_DISTINCT_PERCENT,
        "C": capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * MOST_CAPITALS_PERCENT,
        "D": text.rlike(SYMBOLS),
    }
    total = F.lit(0)
    for name, test in tests.items():
        total = total + F.when(test, BIT[name]).otherwise(0)
    return total


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits), n, good and toxic: documents by the set of filters they fail.

    Equal rows are merged before they meet anything, so no key of a join below is held by more
    rows than there are different texts of one id.
    """
    text = whole_text()
    rows = staged(
        documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            failures(text).alias("fails"),
            F.unhex(F.sha2(text, 256)).alias("same_text"),
        )
        .groupBy("doc_id", "part", "fails", "same_text")
        .agg(F.count("*").alias("n")),
        "filter-audit",
    )
    firsts = (
        rows.where("doc_id IS NOT NULL")
        .groupBy("same_text")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("is_first", F.lit(True))
    )
    known = (
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"),
        )
    )
    repeats = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (
        rows.join(firsts, ["same_text", "doc_id"], "left")
        .join(known, "doc_id", "left")
        .groupBy("part", (F.col("fails") + F.when(repeats, BIT["E"]).otherwise(0)).alias("fails"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
        )
    )


def coalition_removals(counts: Sequence[int]) -> list[int]:
    """How many documents fail a member of each coalition, from the counts by failed set."""
    return [
        sum(n for fails, n in enumerate(counts) if fails & members) for members in range(len(counts))
    ]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    size = len(matrix)
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for i in range(size):
        pivot = next(r for r in range(i, size) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [value / rows[i][i] for value in rows[i]]
        for r in range(size):
            if r != i and rows[r][i]:
                rows[r] = [a - rows[r][i] * b for a, b in zip(rows[r], rows[i])]
    return [row[-1] for row in rows]


def shapley_values(removals: Sequence[int]) -> list[Fraction]:
    """One value a player from the worth of all coalitions, by constrained least squares.

    Normal equations of the kernel-weighted fit with a multiplier for the constraint that the
    values add up to the worth of everyone.
    """
    players = len(removals).bit_length() - 1
    everyone = len(removals) - 1
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [Fraction(0)] * (players + 1)
    for members in range(1, everyone):
        size = members.bit_count()
        weight = Fraction(players - 1, comb(players, size) * size * (players - size))
        present = [i for i in range(players) if members >> i & 1]
        for i in present:
            right[i] += weight * removals[members]
            for j in present:
                matrix[i][j] += weight
    for i in range(players):
        matrix[i][players] = matrix[players][i] = Fraction(1)
    right[players] = Fraction(removals[everyone])
    return solved(matrix, right)[:players]


def audited(counts: dict[str, list[int]]) -> Iterator[tuple]:
    """All rows of a part but its name, from its counts by failed set: n, good and toxic."""
    removed, good, toxic = (coalition_removals(counts[name]) for name in ("n", "good", "toxic"))
    documents = sum(counts["n"])
    orders = factorial(len(FILTERS))
    shares = [int(value * orders) for value in shapley_values(removed)]
    for order in permutations(range(len(FILTERS))):
        label, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            yield (
                label,
                step,
                documents - removed[after],
                here,
                removed[1 << i] - here,
                removed[ALL] - removed[ALL ^ 1 << i],
                good[after] - good[before],
                toxic[after] - toxic[before],
                shares[i],
            )
            before = after


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
        + [
            (name, pa.int64())
            for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
        ]
    )
    for batch in batches:
        for row in batch.to_pylist():
            counts = {name: [0] * (ALL + 1) for name in ("n", "good", "toxic")}
            for entry in row["counts"]:
                for name in counts:
                    counts[name][entry["fails"]] = entry[name]
            lines = list(zip(*audited(counts)))
            columns = [[row["part"]] * len(lines[0]), *lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values), field.type) for values, field in zip(columns, schema)], schema=schema
            )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the step, for all orders of the five filters.

    ``shapley`` is the value times the number of orders: removals summed over all of them.
    """
    entry = F.struct("fails", "n", "good", "toxic")
    parts = failure_counts(documents, labels).groupBy("part").agg(F.collect_list(entry).alias("counts"))
    return parts.mapInArrow(_reports, RESULT)
