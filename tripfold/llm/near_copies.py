"""Near-dedup by exact shingle Jaccard similarity, for the pipeline.

Two documents are near copies when the sets of their five-word shingles have a Jaccard similarity
of ``SIMILARITY`` or more; groups are the components of these pairs. No pair is missed: in any
common order of shingles, the first n - ceil(t * n) + 1 of a set of n (its prefix) hold one of
every set that is similar enough. The order puts shingles that are common in a bounded sample
last, so prefixes are made of rare ones; the sample changes the cost, not the result.

Equal sets are one node. The candidates are the links of the vantage-point trees of ``simhash``
between the SimHash fingerprints of the sets, and of every prefix shingle the links of its nodes to
the least one of them; those similar enough make components. An exact pass follows for what
fingerprints miss: all pairs of two components that share a shingle which may be the first they
share, that is, at a place in both orders that leaves room for the overlap. The number of prefix
shingles a pair shares bounds its overlap from above, and only pairs whose bound is high enough are
compared, on the whole sets.

Words are lower-cased (ASCII) and cut at ASCII white space, as in ``simhash``. Defined results:

* texts without words are one group; fewer words than a shingle make one shingle of them all;
* repeated shingles count once; a null text is empty; other columns are not looked at;
* of a group the least id stays, then the least text hash; rows that repeat whole are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import matched_rows, row_key, small_side, staged, whole_text
from tripfold.llm.components import components
from tripfold.llm.simhash import close_links, print_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SEED = 42
SAMPLE = 20_000  # documents whose shingles give the order
COMMON = 200_000  # shingles put last at most
SLACK = 1e-9  # keeps ceil right where doubles miss a whole number


def shingles_of(text: str) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    ends = (np.cumsum([len(word) + 1 for word in words]) - 1).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = max(1, len(words) - SHINGLE_WORDS + 1)
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[start:end], SEED)
        for start, end in zip(starts[:last], ends[min(SHINGLE_WORDS, len(words)) - 1 :])
    ]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def key_of(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def prefix_of(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in the common order: by count in the sample, then by hash."""
    n = len(shingles)
    if not n:
        return shingles
    often = np.zeros(n, np.int64)
    if len(common):
        place = np.searchsorted(common, shingles).clip(max=len(common) - 1)
        often = np.where(common[place] == shingles, counts[place], 0)
    length = n - int(np.ceil(similarity * n - SLACK)) + 1
    return shingles[np.argsort(often, kind="stable")[:length]]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("hash"), whole_text().alias("text")
    )


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)])
    values = np.concatenate([np.zeros(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _common(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that three or more of a sample of the documents have, ascending, and how many."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles_of(text.as_py()))], names=["shingle"])

    rows = documents.count()
    every = max(1, -(-rows // SAMPLE))
    chosen = documents.where(F.pmod(F.xxhash64(row_key()), F.lit(every)) == 0).select(whole_text().alias("text"))
    found = (
        chosen.distinct()
        .mapInArrow(cut, "shingle bigint")
        .groupBy("shingle")
        .count()
        .where("count >= 3")
        .orderBy(F.desc("count"), "shingle")
        .limit(COMMON)
        .collect()
    )
    shingle = np.array([row[0] for row in found], np.int64)
    order = np.argsort(shingle)
    return shingle[order], np.array([row[1] for row in found], np.int64)[order]


def prefixes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, hash, key (of the set of shingles), n (its size), print and prefix of every document."""
    common, counts = _common(documents)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, prints, firsts = [], [], [], []
            for text in batch.column(2):
                shingles = shingles_of(text.as_py())
                keys.append(key_of(shingles))
                sizes.append(len(shingles))
                prints.append(print_of(shingles.view(np.uint64)))
                firsts.append(prefix_of(shingles, common, counts, similarity))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    _lists(firsts),
                ],
                names=["doc_id", "hash", "key", "n", "print", "prefix"],
            )

    return _texts(documents).mapInArrow(
        cut, "doc_id bigint, hash bigint, key bigint, n bigint, print bigint, prefix array<bigint>"
    )


def _needed(similarity: float) -> Column:
    """The overlap of sets of n_a and n_b shingles at the similarity."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(similarity / (1 + similarity)) - SLACK)


def _hopeful(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """a, b, n_a and n_b of the pairs whose shared prefix shingles let them overlap enough.

    What the set whose prefix ends first shares lies in its prefix, and then in both, or behind it.
    """
    behind = F.ceil(F.greatest("n_a", "n_b") * F.lit(similarity) - SLACK) - 1
    sides = [nodes.select(F.col("key").alias(side), F.col("prefix").alias(f"prefix_{side}")) for side in "ab"]
    return (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .where(F.size(F.array_intersect("prefix_a", "prefix_b")) + behind >= _needed(similarity))
        .select("a", "b", "n_a", "n_b")
    )


def _first(similarity: float) -> Column:
    """Whether a shingle at place_a and place_b of two orders may be the first the sets share."""
    needed = _needed(similarity)
    return (F.col("n_a") - F.col("place_a") >= needed) & (F.col("n_b") - F.col("place_b") >= needed)


def _close(nodes: DataFrame) -> DataFrame:
    """Pairs a, b, n_a, n_b that connect all nodes whose fingerprints differ in a few bits."""
    prints = staged(nodes.groupBy("print").agg(F.min(F.struct("key", "n")).alias("least")), "copy-prints")
    links = staged(close_links(prints.select("print")).distinct(), "copy-print-links")
    ends = [prints.select(F.col("print").alias(side), F.col("least").alias(f"least_{side}")) for side in "ab"]
    between = links.join(ends[0], "a").join(ends[1], "b").select("least_a", "least_b")
    # Different sets of one fingerprint hang on the least of them.
    within = (
        nodes.join(prints, "print")
        .where("key <> least.key")
        .select(F.col("least").alias("least_a"), F.struct("key", "n").alias("least_b"))
    )
    return between.union(within).select(
        F.col("least_a.key").alias("a"), F.col("least_b.key").alias("b"), F.col("least_a.n").alias("n_a"), F.col("least_b.n").alias("n_b")
    )


def _verified(pairs: DataFrame, documents: DataFrame, kept: DataFrame, similarity: float) -> DataFrame:
    """Pairs a, b whose whole sets are similar enough."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [shingles_of(text.as_py()) for text in batch.column(2)]
            keys = pa.array([key_of(a) for a in arrays], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, _lists(arrays)], names=["key", "shingles"])

    pairs = staged(pairs, "copy-candidates")
    wanted = staged(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "copy-keys")
    rows = staged(kept.join(small_side(wanted), "key", "left_semi").select("kept.doc_id", "kept.hash"), "copy-rows")
    sets = (
        _texts(matched_rows(documents, rows, "left_semi"))
        .dropDuplicates(["doc_id", "hash"])
        .mapInArrow(cut, "key bigint, shingles array<bigint>")
    )
    sets = staged(sets, "copy-sets")
    shared = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("right")), "b")
        .where(shared >= _needed(similarity))
        .select("a", "b")
    )


def near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The prefixes of every document, and root and the kept row of every group."""
    cut = staged(prefixes(documents, similarity), "copy-prefixes")
    # nulls last: an id wins over none
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "hash")
    kept = staged(
        cut.groupBy("key").agg(F.min(order).alias("kept"), F.count("*").alias("rows")), "copy-keys-kept"
    )
    # Of equal sets one document goes on, so that a group of copies meets nothing often.
    several = small_side(staged(kept.where("rows > 1").select("key", "kept"), "copies"))
    other = (F.col("kept.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("kept.hash") == F.col("hash"))
    nodes = cut.join(several, "key", "left").where(F.col("kept").isNull() | other)
    nodes = staged(nodes.select("key", "n", "print", "prefix").dropDuplicates(["key"]), "copy-nodes")
    entries = nodes.select(F.posexplode("prefix").alias("place", "shingle"), "key", "n")
    shared = (
        entries.groupBy("shingle")
        .agg(F.min(F.struct("key", "n")).alias("least"), F.max("key").alias("most"))
        .where("least.key <> most")
        .select("shingle", "least")
    )
    shared = small_side(staged(shared, "copy-shingles"))
    members = staged(entries.join(shared, "shingle"), "copy-members")

    sized = (F.col("n_a") >= F.ceil(F.col("n_b") * similarity - SLACK)) & (
        F.col("n_b") >= F.ceil(F.col("n_a") * similarity - SLACK)
    )
    stars = members.where("key <> least.key").select(
        F.col("least.key").alias("a"), F.col("key").alias("b"), F.col("least.n").alias("n_a"), F.col("n").alias("n_b")
    )
    hopeful = _hopeful(staged(_close(nodes).union(stars).where(sized).distinct(), "copy-near"), nodes, similarity)
    first = staged(_verified(hopeful, documents, kept, similarity), "copy-links")
    roots = staged(components(first), "copy-roots").select(F.col("node").alias("key"), "root")
    placed = members.join(small_side(roots), "key", "left").select(
        "shingle", "place", "key", "n", F.coalesce("root", "key").alias("root")
    )
    placed = staged(placed, "copy-placed")
    left, right = (
        placed.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "place", "n", "root")))
        for side in "ab"
    )
    apart = (F.col("key_a") < F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & sized & _first(similarity)
    rest = (
        left.join(right.withColumnRenamed("shingle", "own"), (F.col("shingle") == F.col("own")) & apart)
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "n_a", "n_b")
        .distinct()
    )
    second = _verified(_hopeful(rest, nodes, similarity), documents, kept, similarity)
    links = first.union(second)
    final = small_side(staged(components(links), "copy-components").withColumnRenamed("node", "key"))
    rooted = staged(
        kept.join(final, "key", "left").select("kept", F.coalesce("root", "key").alias("root")),
        "copy-rooted",
    )
    return cut, rooted.groupBy("root").agg(F.min("kept").alias("kept"))


def one_of_each(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, with one of each group of near copies."""
    cut, kept = near_copies(documents, similarity)
    keys = staged(kept.select("kept.doc_id", "kept.hash"), "kept-copies")
    result = matched_rows(documents, keys, "left_semi")
    stays = small_side(keys.select(F.struct("doc_id", "hash").alias("stays")))
    rows = cut.select("doc_id", "hash").join(stays, F.struct("doc_id", "hash").eqNullSafe(F.col("stays")), "left_semi")
    # Only a table that repeats kept rows whole needs them made one.
    return result.dropDuplicates(["doc_id", "text"]) if rows.count() > keys.count() else result
