"""Line dedup: boilerplate lines, found by the number of distinct sites that carry them.

A line is boilerplate when at least ``min_sites`` distinct sites have it. Every line hash gets a
HyperLogLog sketch of its sites; sketches merge by aggregation, map side first, so a hot line
costs one sketch per task. Lines whose estimate is clear of the threshold by ``margin`` are
decided by it; the others get exact distinct counts. Of a boilerplate line one occurrence stays
(lowest document id, then text hash, then position), so that no content leaves the corpus; all
others are removed.

Lines are the parts between line feeds, compared without surrounding blanks, tabs and carriage
returns, by a 128-bit hash. Defined results:

* blank lines are never boilerplate; they stay;
* a null text stays null and has no lines; an empty one stays empty;
* null sites count as one site;
* rows with equal id and equal text are one document and get the same result; ids may be null;
* other columns pass through, whatever their names; empty tables give no rows.

Document rows never meet in a group: hashes are aggregated, and only positions travel back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import fresh_name, row_key, small_side, staged

MIN_SITES = 3
MARGIN = 0.34  # of the threshold; many standard errors of a sketch of 2**12 registers
LG_REGISTERS = 12


def _line_parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_occurrences(documents: DataFrame, site: str = "source") -> DataFrame:
    """One row per non-blank line: h1, h2 (its hash), site hash, doc (id, text hash), position."""
    return (
        documents.where(F.col("text").isNotNull())
        .select(
            F.struct(F.col("doc_id").alias("id"), row_key().alias("hash")).alias("doc"),
            F.xxhash64(site).alias("site"),
            F.posexplode(_line_parts(F.col("text"))).alias("position", "raw"),
        )
        .withColumn("line", F.btrim("raw", F.lit(" \t\r")))
        .where(F.col("line") != "")
        .select(
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
            "site",
            "doc",
            "position",
        )
    )


def boilerplate_lines(
    occurrences: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN
) -> DataFrame:
    """h1, h2 and kept (doc and position of the occurrence that stays) of every boilerplate line."""
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    spread = staged(
        occurrences.groupBy("h1", "h2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_REGISTERS))).alias("estimate"),
            F.min(F.struct("doc", "position")).alias("kept"),
        )
        .where(F.col("estimate") > low),
        "line-spread",
    )
    unsure = small_side(spread.where(F.col("estimate") < high).select("h1", "h2"))
    exact = (
        occurrences.select("h1", "h2", "site")
        .join(unsure, ["h1", "h2"])
        .distinct()
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= min_sites)
        .select("h1", "h2")
    )
    sure = spread.where(F.col("estimate") >= high).select("h1", "h2")
    return spread.join(sure.union(exact), ["h1", "h2"], "left_semi").select("h1", "h2", "kept")


def without_boilerplate(
    documents: DataFrame,
    min_sites: int = MIN_SITES,
    margin: float = MARGIN,
    site: str = "source",
) -> DataFrame:
    """All documents and columns with boilerplate lines cut from ``text``.

    Adds n_lines and n_removed (names made free if taken, in that order at the end). Whatever
    other columns depend on the text, such as a length, is the caller's to update.
    """
    occurrences = line_occurrences(documents, site)
    boilerplate = small_side(staged(boilerplate_lines(occurrences, min_sites, margin), "boilerplate"))
    removed = staged(
        occurrences.join(boilerplate, ["h1", "h2"])
        .where(F.struct("doc", "position") != F.col("kept"))
        .groupBy("doc")
        .agg(F.collect_set("position").alias("positions")),
        "removed-lines",
    )
    doc, positions = fresh_name(documents, "line_doc"), fresh_name(documents, "line_positions")
    n_lines, n_removed = fresh_name(documents, "n_lines"), fresh_name(documents, "n_removed")
    # Not forced to broadcast: rows hold arrays, and the planner knows the size of the files.
    removed = removed.select(F.col("doc").alias(doc), F.col("positions").alias(positions))
    key = F.struct(F.col("doc_id").alias("id"), row_key().alias("hash"))
    # One array per call of the outer lambda, so that lines are split once a row.
    kept_text = F.get(
        F.transform(
            F.array(_line_parts(F.col("text"))),
            lambda lines: F.array_join(
                F.transform(
                    F.array_except(
                        F.sequence(F.lit(0), F.size(lines) - 1),
                        F.coalesce(F.col(positions), F.array().cast("array<int>")),
                    ),
                    lambda i: F.get(lines, i),
                ),
                "\n",
            ),
        ),
        F.lit(0),
    )
    joined = documents.join(removed, key.eqNullSafe(F.col(doc)), "left")
    cut = F.coalesce(F.size(positions), F.lit(0))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(_line_parts(F.col("text"))))
    return joined.select(
        *(
            F.when(cut > 0, kept_text).otherwise(F.col("text")).alias("text")
            if name == "text"
            else documents[name]
            for name in documents.columns
        ),
        lines.cast("bigint").alias(n_lines),
        F.when(cut > 0, cut).otherwise(0).cast("bigint").alias(n_removed),
    )
