"""SimHash near-dedup: exact pairs within a Hamming distance, by vantage-point trees.

Distinct fingerprints are searched, not documents. Two fingerprints that differ in at most
``radius`` bits differ in at most radius // PARTS bits of one of their PARTS parts, so each part
gets a vantage-point tree on the Hamming distance of that part. An inner node holds a vantage
point and the median distance to it; nearer values go inside, others outside. A search goes down
a side only if the triangle inequality leaves something within the part's radius there. Leaves
are shards: a fingerprint lives in its home leaf and also visits the leaves of higher number its
search reaches, so every close pair meets in one leaf, where all 64 bits are compared.

A leaf too large for one task is cut into blocks and pairs of blocks become tasks, so nothing is
dropped. Within a task links are reduced to a spanning forest at once: a group of n copies
leaves n - 1 links at most, never all pairs. Components come from ``components``.

The trees are fitted on at most ``SAMPLE`` fingerprints (the least by hash); all are indexed, and
the result does not depend on the trees, only its cost does. Defined results:

* no words: fingerprint zero, linked like any other; a null text is empty;
* fewer words than a shingle: one shingle of them all; repeated shingles count each time;
* repeated rows share a fingerprint; a null document id is never a component's id unless the
  component has no other; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import matched_rows, row_key, small_side, staged, whole_text
from tripfold.llm.components import components

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
PARTS = 4
PART_BITS = 64 // PARTS
SAMPLE = 65_536
LEAF_ROWS = 1000  # fingerprints a leaf should hold
DEEPEST = 13
BLOCK_ROWS = 16_000  # fingerprints of a leaf that one task compares at most


# fingerprints


def fingerprint_of(text: str) -> int:
    """The unsigned 64-bit SimHash of a text."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = (np.cumsum([len(word) + 1 for word in words]) - 1).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = max(1, len(words) - SHINGLE_WORDS + 1)
    hashes = [
        digest(joined[start:end], SEED)
        for start, end in zip(starts[:last], ends[min(SHINGLE_WORDS, len(words)) - 1 :])
    ]
    return print_of(np.array(hashes, np.uint64))


def print_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half the unsigned 64-bit hashes; 0 without any."""
    counts = np.zeros(64, np.int64)
    data = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(data), 1 << 16):
        counts += np.unpackbits(data[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, hash (of the text; tells rows of one id apart) and print, a signed bigint."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint_of(t.as_py()) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                names=["doc_id", "hash", "print"],
            )

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("hash"), whole_text().alias("text")
    ).mapInArrow(printed, "doc_id bigint, hash bigint, print bigint")


# vantage-point trees


def _part(values: np.ndarray, part: int) -> np.ndarray:
    shift = np.uint64(64 - PART_BITS * (part + 1))
    return ((values >> shift) & np.uint64((1 << PART_BITS) - 1)).astype(np.uint32)


def vantage_tree(values: np.ndarray, depth: int, rng: np.random.Generator) -> tuple | int:
    """(vantage point, median distance, inside, outside), or 0 for a leaf."""
    if depth == 0 or len(values) < 2:
        return 0
    vantage = int(values[rng.integers(len(values))])
    distance = np.bitwise_count(values ^ np.uint32(vantage))
    median = int(np.median(distance))
    inside = distance <= median
    if inside.all():  # the median is the largest distance: cut below it
        median -= 1
        inside = distance <= median
    if median < 0 or not inside.any():
        return 0
    return (
        vantage,
        median,
        vantage_tree(values[inside], depth - 1, rng),
        vantage_tree(values[~inside], depth - 1, rng),
    )


def leaves_of_tree(tree: tuple | int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For every value of a part: home leaf, and the leaves above it that its search visits.

    Returns homes, offsets and visits: value v visits visits[offsets[v]:offsets[v + 1]]; and the
    number of leaves.
    """
    every = np.arange(1 << PART_BITS, dtype=np.uint32)
    homes = np.zeros(len(every), np.int32)
    who, where, leaf = [], [], 0

    def descend(node, searching: np.ndarray, living: np.ndarray) -> None:
        nonlocal leaf
        if node == 0:
            homes[living] = leaf
            who.append(searching)
            where.append(np.full(len(searching), leaf, np.int32))
            leaf += 1
            return
        vantage, median, inside, outside = node
        far = np.bitwise_count(searching ^ np.uint32(vantage)).astype(np.int32)
        near = np.bitwise_count(living ^ np.uint32(vantage)) <= median
        # within radius of the searcher lie distances from far - radius to far + radius
        descend(inside, searching[far - radius <= median], living[near])
        descend(outside, searching[far + radius > median], living[~near])

    descend(tree, every, every)
    who_all, where_all = np.concatenate(who), np.concatenate(where)
    above = where_all > homes[who_all]
    who_all, where_all = who_all[above], where_all[above]
    order = np.argsort(who_all, kind="stable")
    counts = np.bincount(who_all, minlength=len(every))
    return homes, np.concatenate(([0], np.cumsum(counts))), where_all[order], leaf


class Forest:
    """A tree per part and where every fingerprint lives and visits; made once per worker."""

    def __init__(self, sample: np.ndarray, expected: int, leaf_rows: int, radius: int, seed: int = 5):
        depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(1, expected / leaf_rows))))))
        rng = np.random.default_rng(seed)
        self.radius = radius
        self.trees = [vantage_tree(_part(sample, part), depth, rng) for part in range(PARTS)]
        self.routes = None

    def __getstate__(self):
        return self.__dict__ | {"routes": None}

    def _routes(self):
        if self.routes is None:
            self.routes, first = [], 0
            for tree in self.trees:
                homes, offsets, visits, leaves = leaves_of_tree(tree, self.radius // PARTS)
                self.routes.append((homes + first, offsets, visits + first))
                first += leaves
            self.leaves = first
        return self.routes

    def placed(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(fingerprints, leaf, at home) for all trees; leaf numbers are unique over trees."""
        for part, (homes, offsets, visits) in enumerate(self._routes()):
            value = _part(prints, part)
            yield prints, homes[value], True
            many = offsets[value + 1] - offsets[value]
            total = int(many.sum())
            begin = np.repeat(offsets[value] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
            yield np.repeat(prints, many), visits[np.arange(total) + begin], False


# close pairs


def spanning_links(home: np.ndarray, visitors: np.ndarray, within: bool, radius: int) -> np.ndarray:
    """Links that connect what pairs of home x home (if ``within``) and visitors x home connect."""
    nodes = np.concatenate([home, visitors])
    label = np.arange(len(nodes))
    links = []
    start = 0 if within else len(home)
    for at in range(start, len(nodes), 64):
        rows = nodes[at : at + 64]
        hits = np.bitwise_count(rows[:, None] ^ home[None, :]) <= radius
        if at < len(home):  # each pair at home once: partners after the row; visitors meet all
            own = np.arange(at, at + len(rows))[:, None]
            hits &= (np.arange(len(home))[None, :] > own) | (own >= len(home))
        for i in np.flatnonzero(hits.any(axis=1)):
            partners = np.flatnonzero(hits[i])
            labels, first = np.unique(label[partners], return_index=True)
            new = labels != label[at + i]
            if new.any():
                for partner in partners[first[new]]:
                    links.append((nodes[at + i], home[partner]))
                label[np.isin(label, labels[new])] = label[at + i]
    return np.array(links, dtype=np.uint64).reshape(-1, 2)


def close_links(
    prints: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Links a, b between distinct fingerprints (column print) that connect all close pairs."""
    if not 0 <= radius < 2 * PARTS:
        raise ValueError("the parts are too few for this radius")
    expected = prints.count()
    sample = prints.select("print", F.xxhash64("print").alias("order")).orderBy("order").limit(SAMPLE)
    values = np.array([row["print"] for row in sample.collect()], dtype=np.int64).view(np.uint64)
    forest = Forest(values, expected, leaf_rows, radius)

    def unsigned(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).to_numpy().astype(np.int64).view(np.uint64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, leaf, at_home in forest.placed(unsigned(batch)):
                number, rows = np.unique(leaf, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), pa.array([at_home] * len(rows), pa.bool_()), pa.array(rows, pa.int64())],
                    names=["leaf", "home", "n"],
                )

    # Rows are bounded by the leaves of the trees, 2 ** DEEPEST each.
    counts = (
        prints.select("print")
        .mapInArrow(counted, "leaf int, home boolean, n bigint")
        .groupBy("leaf", "home")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > block_rows)
        .collect()
    )
    blocks = {(row.leaf, row.home): -(-row.n // block_rows) for row in counts}
    crowded = np.array(sorted({leaf for leaf, _ in blocks}), dtype=np.int64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, leaf, at_home in forest.placed(unsigned(batch)):
                leaf = leaf.astype(np.int64)
                rest = np.isin(leaf, crowded) if len(crowded) else np.zeros(len(leaf), bool)
                yield _rows(own[~rest], leaf[~rest], np.zeros((~rest).sum(), np.int64), at_home, True)
                for number in np.unique(leaf[rest]):
                    mine = own[leaf == number]
                    yield from _block_rows(mine, int(number), at_home, blocks)

    def compared(group):
        value = group["print"].to_numpy().view(np.uint64)
        home = group["home"].to_numpy()
        links = spanning_links(value[home], value[~home], bool(group["within"].iloc[0]), radius)
        return pd.DataFrame({"a": links[:, 0].view(np.int64), "b": links[:, 1].view(np.int64)})

    return (
        prints.select("print")
        .mapInArrow(dealt, "leaf bigint, task bigint, print bigint, home boolean, within boolean")
        .groupBy("leaf", "task")
        .applyInPandas(compared, "a bigint, b bigint")
    )


def _rows(prints, leaf, task, at_home: bool, within: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(leaf, pa.int64()),
            pa.array(task, pa.int64()),
            pa.array(prints.view(np.int64), pa.int64()),
            pa.array(np.full(len(prints), at_home)),
            pa.array(np.full(len(prints), within)),
        ],
        names=["leaf", "task", "print", "home", "within"],
    )


def _block_rows(prints: np.ndarray, leaf: int, at_home: bool, blocks: dict) -> Iterator[pa.RecordBatch]:
    """Rows of a crowded leaf: home blocks meet themselves, each other and every visitor block.

    Task (v, i, j) compares block i with home block j: v = 0 and i = j is a home block with the
    first visitor block; v = 0 and i < j are two home blocks; v > 0 a later visitor block.
    """
    homes, guests = blocks.get((leaf, True), 1), blocks.get((leaf, False), 1)
    own = homes if at_home else guests
    mixed = prints * np.uint64(0x9E3779B97F4A7C15)
    block = ((mixed >> np.uint64(33)) % np.uint64(own)).astype(np.int64)
    number = lambda v, i, j: (v << 40) + (i << 20) + j
    for b in range(own):
        mine = prints[block == b]
        if not len(mine):
            continue
        if at_home:
            tasks = [(number(0, b, b), True, True)]
            tasks += [(number(0, b, j), False, False) for j in range(b + 1, homes)]
            tasks += [(number(0, i, b), True, False) for i in range(b)]
            tasks += [(number(v, b, b), True, False) for v in range(1, guests)]
        else:
            tasks = [(number(b, j, j), False, b == 0) for j in range(homes)]
        for task, as_home, within in tasks:
            n = len(mine)
            yield _rows(mine, np.full(n, leaf), np.full(n, task), as_home, within)


# documents


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, hash, print and component_id (least document id reachable) of every document."""
    printed = staged(fingerprints(documents), "prints")
    nodes = staged(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    links = close_links(nodes, radius)
    linked = staged(components(links), "print-components").withColumnRenamed("node", "print")
    grouped = nodes.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = grouped.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("least").alias("component_id"))
    # Prints without a link are their own root; only the linked ones need the join.
    named = staged(
        grouped.join(least, "root").select("print", "root", "component_id"), "print-names"
    )
    return printed.join(small_side(named), "print").select("doc_id", "hash", "print", "root", "component_id")


def one_of_each(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents, all columns, with one of each group: least id, then text hash.

    Rows that repeat whole are one document. A group without any id keeps its least text hash.
    """
    groups = near_duplicates(documents, radius)
    # nulls last: an id wins over none
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "hash")
    kept = staged(groups.groupBy("root").agg(F.min(order).alias("kept"), F.count("*").alias("rows")), "kept")
    keys = kept.select("kept.doc_id", "kept.hash")
    result = matched_rows(documents, keys, "left_semi")
    stays = small_side(keys.select(F.struct("doc_id", "hash").alias("stays")))
    rows = groups.join(stays, F.struct("doc_id", "hash").eqNullSafe(F.col("stays")), "left_semi")
    repeated = rows.count() > kept.count()
    # Only a table that repeats kept rows whole needs them made one.
    return result.dropDuplicates(["doc_id", "text"]) if repeated else result


def as_hex(column: str = "print") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
