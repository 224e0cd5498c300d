"""Source divergence audit: how far the words of a source lie from those of the others.

Terms are runs of letters (A-Z lower-cased, and all bytes beyond ASCII). Each language keeps the
terms that at least ``LEAST_DOCUMENTS`` of its documents hold. They are found by iceberg prefix
refinement: the byte prefixes of a first width are counted by the distinct documents that hold a
term with them; prefixes below the threshold are discarded, since no term with them can reach it;
the others are extended, to twice the width, level by level, until only complete terms remain. A
term is complete at the first level that is longer than it; an end mark (a zero byte, which no term
holds) tells it from longer ones. Complete terms are counted by source as well, in the same pass.

Every level is one scan of the texts. A task counts in a bounded table that it sends off when full,
then the counts are added up by key. The prefixes that survive go to the tasks as one bitmap of
their hashes, of at most ``MOST_BITS`` bits whatever the corpus: a prefix that passes it by accident
is counted once more and discarded then, so it costs time, never the result.

The comparison works on blocks of terms of a language, dealt by hash: each block meets the list of
the language's groups (as many rows as it has sources) and computes with 64-bit integers the
divergence of all sources and the ten terms of each that stand out. The blocks' results are added
up. A block has as many terms as the square of the number of sources suggests, so what the
blocks send is never more than what they read.

Everything is exact. Defined results: null text, language and source are empty ones; a document
without a term still makes its group; repeated rows are documents of their own; a language without
kept terms gives divergences of zero; equal values are ranked by the item's UTF-8; an empty table
gives no rows. Only ``text``, ``lang`` and ``source`` are looked at, whole texts always.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfold.llm.common import staged

LEAST_DOCUMENTS = 10
FIRST_WIDTH = 6
TOP_TERMS = 10
SCALE = 1_000_000_000
MOST_BITS = 1 << 28  # 32 MB
BITS_PER_PREFIX = 16
PIECE = 4096 * 8  # bits of one aggregated bitmap

# Entries and bytes of keys a task counts before it sends them off; prefixes it remembers.
TABLE_ENTRIES, TABLE_BYTES, REMEMBERED = 400_000, 32 << 20, 200_000
BLOCK_CELLS = 1 << 16  # counts a block holds, about
CHUNK_CELLS = 1 << 18  # and computes with at a time

END = b"\0"
# A-Z lower-cased; what separates terms becomes a blank.
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


# --- iceberg prefix refinement --------------------------------------------------------------


class Survivors(dict):
    """Whether a language's prefixes go on to the next level, by a bitmap of hashes.

    Remembers the answers for so many prefixes; the others are looked up each time.
    """

    def __init__(self, lang: str, bits: bytes):
        super().__init__()
        self.mark, self.bits, self.mask = lang.encode() + END, bits, len(bits) * 8 - 1

    def __missing__(self, prefix: bytes) -> int:
        at = xxhash.xxh64_intdigest(self.mark + prefix, 42) & self.mask
        found = self.bits[at >> 3] >> (at & 7) & 1
        if len(self) < REMEMBERED:
            self[prefix] = found
        return found


def _counted(width: int, survivors):
    """Documents and occurrences by language, source and prefix, partial sums of a task.

    ``survivors`` is None at the first level, else holds those of half the width. Longer
    prefixes count for the language, with no source; complete terms for the source too.
    """
    most = min(TABLE_ENTRIES, TABLE_BYTES // width)

    def send(longer: dict, complete: dict) -> pa.RecordBatch:
        langs, sources, prefixes, documents, occurrences = [], [], [], [], []
        for lang, table in longer.items():
            langs += [lang] * len(table)
            sources += [None] * len(table)
            prefixes += table
            documents += table.values()
            occurrences += [0] * len(table)
        for (lang, source), (held, found) in complete.items():
            langs += [lang] * len(held)
            sources += [source] * len(held)
            prefixes += [term + END for term in held]
            documents += held.values()
            occurrences += map(found.__getitem__, held)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(sources, pa.string()),
                pa.array(prefixes, pa.binary()),
                pa.array(documents, pa.int64()),
                pa.array(occurrences, pa.int64()),
            ],
            names=["lang", "source", "prefix", "documents", "occurrences"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive: dict[str, Survivors] = {}
        longer: dict[str, Counter] = {}
        complete: dict[tuple, tuple[Counter, Counter]] = {}
        entries, half = 0, width // 2
        for batch in batches:
            texts, langs, sources = batch.columns
            for text, lang, source in zip(texts, langs.to_pylist(), sources.to_pylist()):
                terms = terms_of(text.as_py())
                if survivors is not None:
                    if lang not in alive:
                        alive[lang] = Survivors(lang, survivors.value)
                    going_on = alive[lang]
                    terms = [t for t in terms if len(t) >= half and going_on[t[:half]]]
                short = [t for t in terms if len(t) < width]
                if short:
                    held, found = complete.setdefault((lang, source), (Counter(), Counter()))
                    entries -= len(held)
                    held.update(set(short))
                    found.update(short)
                    entries += len(held)
                if len(short) < len(terms):
                    table = longer.setdefault(lang, Counter())
                    entries -= len(table)
                    table.update({t[:width] for t in terms if len(t) >= width})
                    entries += len(table)
                if entries > most:
                    yield send(longer, complete)
                    longer.clear()
                    complete.clear()
                    entries = 0
        if entries:
            yield send(longer, complete)

    return count


def kept_terms(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, source and occurrences of the terms that ``least`` documents of a language hold."""
    spark = documents.sparkSession
    texts = documents.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    )
    width, survivors, complete = FIRST_WIDTH, None, []
    while True:
        level = staged(
            texts.mapInArrow(
                _counted(width, survivors),
                "lang string, source string, prefix binary, documents bigint, occurrences bigint",
            )
            .groupBy("lang", "source", "prefix")
            .agg(F.sum("documents").alias("documents"), F.sum("occurrences").alias("occurrences")),
            "prefix-level",
        )
        by_source = F.collect_list(F.struct("source", "occurrences"))
        complete.append(
            level.where("source IS NOT NULL")
            .groupBy("lang", "prefix")
            .agg(F.sum("documents").alias("documents"), by_source.alias("places"))
            .where(F.col("documents") >= least)
            .select("lang", "prefix", F.inline("places"))
        )
        going_on = level.where(F.col("source").isNull() & (F.col("documents") >= least))
        count = going_on.count()
        if not count:
            break
        survivors = spark.sparkContext.broadcast(survivor_bits(going_on, count))
        width *= 2
    kept = complete[0]
    for more in complete[1:]:
        kept = kept.union(more)
    term = F.expr("substring(prefix, 1, length(prefix) - 1)").cast("string")
    return kept.select("lang", term.alias("term"), "source", "occurrences")


def survivor_bits(prefixes: DataFrame, count: int) -> bytes:
    """A bitmap of the hashes of (lang, prefix), of a power of two of bits."""
    bits = PIECE
    while bits < min(count * BITS_PER_PREFIX, MOST_BITS):
        bits *= 2
    name = F.concat(F.col("lang").cast("binary"), F.lit(END), F.col("prefix"))
    at = F.xxhash64(name).bitwiseAND(F.lit(bits - 1)) + 1
    pieces = (
        prefixes.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
        .collect()
    )
    whole = bytearray(bits // 8)
    for row in pieces:  # at most MOST_BITS / PIECE
        start = (row.piece - 1) * PIECE // 8
        whole[start : start + PIECE // 8] = row.bitmap
    return bytes(whole)


# --- comparison -----------------------------------------------------------------------------


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), without leaving 64 bits."""
    whole = total + 2 * terms
    rest, value = counts + 2, np.zeros_like(counts)
    for _ in range(3):  # three decimal digits at a time
        rest = rest * 1000
        value = value * 1000 + rest // whole
        rest = rest % whole
    return value + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


COMPARED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
)


def _compared(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial divergences of all sources over a block of terms, and its leading terms of each."""
    lang, vocabulary = groups["lang"][0].as_py(), groups["terms"][0].as_py()
    sources = groups["source"].to_pylist()
    totals = groups["occurrences"].to_numpy()
    names = pc.unique(terms["term"]).to_pylist()
    names.sort(key=str.encode)
    rows = pc.index_in(terms["term"], pa.array(names, pa.string())).to_numpy()
    columns = pc.index_in(terms["source"], pa.array(sources, pa.string())).to_numpy()
    occurrences = terms["occurrences"].to_numpy()
    order = np.argsort(rows, kind="stable")
    rows, columns, occurrences = rows[order], columns[order], occurrences[order]
    n = len(sources)
    apart = np.zeros((n, n), dtype=np.int64)
    best: list[list[tuple[int, int]]] = [[] for _ in sources]  # (value, place of the term)
    step = max(1, CHUNK_CELLS // n)
    for start in range(0, len(names), step):
        stop = min(start + step, len(names))
        low, high = np.searchsorted(rows, [start, stop])
        counts = np.zeros((stop - start, n), dtype=np.int64)
        counts[rows[low:high] - start, columns[low:high]] = occurrences[low:high]
        p = shares(counts, totals, vocabulary)
        whole = shares(counts.sum(axis=1), totals.sum(), vocabulary)
        for g in range(n):
            apart[g] += divergence(p[:, g, None], p).sum(axis=0)
            places = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > whole))
            values = divergence(p[places, g], whole[places])
            first = np.lexsort((places, -values))[:TOP_TERMS]
            best[g] += [(int(values[i]), start + int(places[i])) for i in first]
    out: dict[str, list] = {name: [] for name in COMPARED.names}

    def add(source, part, items, values):
        out["lang"] += [lang] * len(items)
        out["source"] += [source] * len(items)
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += values

    for g, source in enumerate(sources):
        others = [h for h in range(n) if h != g]
        add(source, "pair", [sources[h] for h in others], apart[g][others].tolist())
        leading = sorted(best[g], key=lambda entry: (-entry[0], entry[1]))[:TOP_TERMS]
        add(source, "term", [names[place] for _, place in leading], [value for value, _ in leading])
    return pa.table(out, schema=COMPARED)


def divergences(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value and rank: other sources and leading terms of every group."""
    kept = staged(kept_terms(documents, least), "kept-terms")
    groups = (
        documents.select(
            *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source"))
        )
        .withColumn("occurrences", F.lit(0).cast("bigint"))
        .distinct()
        .unionByName(kept.drop("term"))
        .groupBy("lang", "source")
        .agg(F.sum("occurrences").alias("occurrences"))
    )
    per_term = F.greatest(F.lit(BLOCK_CELLS) / F.col("sources"), F.col("sources") * 8)
    languages = staged(
        groups.groupBy("lang")
        .agg(F.count("*").alias("sources"))
        .join(kept.groupBy("lang").agg(F.countDistinct("term").alias("terms")), "lang", "left")
        .select("lang", "sources", F.coalesce("terms", F.lit(0)).alias("terms"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / per_term)).cast("bigint")),
        "languages",
    )
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    terms = kept.join(languages.select("lang", "blocks"), "lang").withColumn("block", block).drop("blocks")
    listed = (
        groups.join(languages, "lang")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .drop("blocks", "sources")
    )
    compared = (
        terms.groupBy("lang", "block")
        .cogroup(listed.groupBy("lang", "block"))
        .applyInArrow(_compared, "lang string, source string, part string, item string, value bigint")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        compared.groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
    )
