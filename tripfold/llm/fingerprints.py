"""Document fingerprints by locally consistent parsing.

Characters get names; level by level, runs of one name are joined, deterministic coin tossing
labels every name from itself and its left neighbours, phrases begin at local maxima of the
labels, and a phrase is named by a hash of the names in it. Where phrases begin depends on a few
neighbours alone, so equal substrings are cut alike away from their ends, whatever their offset,
and share interior names on every level. Names are hashes of content: no dictionary is shared.

A fingerprint is a sketch of a text's phrase names: 64 cells of 16 bits, dealt to the levels
(``CELLS``), each the least hash of the names that fall in it, 0 if none do. Likeness is the share of
cells that agree among those that either has; it estimates the common part of the names.

Many texts are parsed at once, one after the other in one array. Defined results: a null text is
empty; empty texts have the all-zero fingerprint, like each other and nothing else; equal texts
have equal fingerprints; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.common import in_id_shards

# Cells of the first, second and third level, and of all above with the name of the whole text.
CELLS = (8, 24, 16, 16)
WIDTH = sum(CELLS)
FIRST_CELL = np.concatenate(([0], np.cumsum(CELLS)))[:-1]
# Code points parsed at once.
BATCH_POINTS = 150_000
DOCUMENTS_PER_SHARD = 4000

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xD6E8FEB86659FD93)
_32, _29 = np.uint64(32), np.uint64(29)
_ONE = np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _K2
    x ^= x >> _32
    x *= _K1
    x ^= x >> _29
    return x


def _toss_table() -> np.ndarray:
    """Label of a name next to its left neighbour, for names below 128: 2 * (lowest bit they
    differ in) + that bit of the name; at [x, x] the last bit of the name."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = left ^ own
    low = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    low[differ == 0] = 0
    return (2 * low + ((own >> low) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()
_TOSSES = 3  # after the first: labels below 128, 14, 8, 6


def _parse(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the next level and the text each belongs to."""
    first = np.empty(len(doc), bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    begins = first.copy()
    begins[1:] |= names[1:] != names[:-1]
    if not begins.all():
        at = np.flatnonzero(begins)
        run = np.diff(at, append=len(names)).astype(np.uint64)
        names, doc, first = names[at], doc[at], first[at]
        long = run > 1
        names[long] = _mix(names[long] + run[long] * _K1)
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = ~names[first]
    differ = names ^ left
    low = np.bitwise_count((differ & (~differ + _ONE)) - _ONE)
    label = ((names >> low.astype(np.uint64)) & _ONE).astype(np.uint8) + 2 * low
    for _ in range(_TOSSES):
        index = np.empty(len(label), np.int32)
        index[1:] = label[:-1]
        index[first] = label[first]
        index <<= 7
        index += label
        label = _TOSS[index]
    rises = np.empty(len(label), bool)
    rises[0] = False
    np.greater(label[1:], label[:-1], out=rises[1:])
    falls = np.empty(len(label), bool)
    falls[-1] = False
    np.greater(label[:-1], label[1:], out=falls[:-1])
    falls[:-1] &= ~first[1:]
    starts = np.flatnonzero((rises & falls) | first)
    sizes = np.diff(starts, append=len(names))
    place = np.arange(len(names), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), sizes)
    return _mix(np.add.reduceat(_mix(names + place * _K1), starts)), doc[starts]


def fingerprints_of(texts: list[str]) -> np.ndarray:
    """A row of cells per text."""
    cells = np.full(len(texts) * WIDTH, 0xFFFF, np.uint16)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        names = _mix(points.astype(np.uint64) + _ONE)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        level = 0
        while len(names):
            names, doc = _parse(names, doc)
            group = min(level, len(CELLS) - 1)
            alone = np.ones(len(doc), bool)
            alone[1:] &= doc[1:] != doc[:-1]
            alone[:-1] &= doc[1:] != doc[:-1]
            _put(cells, names, doc, group)
            if alone.any():
                # the name of a whole text always counts among the top cells
                if group < len(CELLS) - 1:
                    _put(cells, names[alone], doc[alone], len(CELLS) - 1)
                names, doc = names[~alone], doc[~alone]
            level += 1
    cells = cells.reshape(len(texts), WIDTH)
    return np.where(cells == 0xFFFF, 0, cells + 1).astype(np.uint16)


def _put(cells: np.ndarray, names: np.ndarray, doc: np.ndarray, group: int) -> None:
    value = _mix(names ^ _K2)
    cell = (value % np.uint64(CELLS[group])).astype(np.int64) + FIRST_CELL[group]
    low = np.minimum((value >> np.uint64(40)) & np.uint64(0xFFFF), np.uint64(0xFFFE)).astype(np.uint16)
    np.minimum.at(cells, doc.astype(np.int64) * WIDTH + cell, low)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row: cells that agree over cells that either has; two empty texts are alike."""
    held = (left != 0) | (right != 0)
    same = (left == right) & held
    total = held.sum(axis=1)
    return np.where(total == 0, 1.0, same.sum(axis=1) / np.maximum(total, 1))


def as_hex(cells: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in cells]


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _followed(documents: DataFrame, per_shard: int) -> tuple[DataFrame, int]:
    """doc_id, text, shard and guest: all rows by shard, and after each shard, as guests, those of
    the id that begins the next one. Ids descend over shards; the first follows the last."""
    frame, count = in_id_shards(documents, per_shard)
    tops = sorted(
        (row.shard, row.top)
        for row in frame.groupBy("shard").agg(F.max("doc_id").alias("top")).collect()
    )
    home = F.array(F.struct(F.col("shard").alias("shard"), F.lit(False).alias("guest")))
    if tops:
        above = {shard: tops[(i + 1) % len(tops)][0] for i, (shard, _) in enumerate(tops)}
        top = dict(tops)
        begins = F.array(*(F.lit(top.get(i)).cast("bigint") for i in range(count)))
        before = F.array(*(F.lit(above.get(i, 0)) for i in range(count)))
        visit = F.array(F.struct(F.get(before, F.col("shard")).alias("shard"), F.lit(True).alias("guest")))
        home = F.when(F.col("doc_id").eqNullSafe(F.get(begins, F.col("shard"))), F.concat(home, visit)).otherwise(home)
    return frame.select("doc_id", "text", F.inline(home)), count


COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edit_report(documents: DataFrame, documents_per_shard: int = DOCUMENTS_PER_SHARD) -> DataFrame:
    """Fingerprints of every text and of its edited form, with likeness to that and to the next.

    The next document is the one after in descending id, rows of one id by text, null ids last;
    after the last comes the first. The edited form ends in a piece of the next document.
    """
    rows, count = _followed(documents, documents_per_shard)

    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the row that waits for its next one
        last_cells = None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            shards, guests = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes = [len(text.as_py()) for text in texts]
            for start, end in _by_sizes(sizes, BATCH_POINTS):
                part = [text.as_py() for text in texts[start:end]]
                cells = fingerprints_of(part)
                chain = held + list(zip(ids[start:end], part, shards[start:end], guests[start:end]))
                all_cells = cells if last_cells is None else np.vstack([last_cells, cells])
                pairs = [
                    i for i in range(len(chain) - 1)
                    if not chain[i][3] and chain[i][2] == chain[i + 1][2]
                ]
                held, last_cells = chain[-1:], all_cells[-1:]
                if not pairs:
                    continue
                edited = [edited_text(chain[i][1], chain[i + 1][1]) for i in pairs]
                at = np.array(pairs)
                edited_cells = fingerprints_of(edited)
                own = all_cells[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chain[i][0] for i in pairs], pa.int64()),
                        pa.array([len(chain[i][1]) for i in pairs], pa.int64()),
                        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
                        pa.array(as_hex(own)),
                        pa.array(as_hex(edited_cells)),
                        pa.array(likeness(own, edited_cells)),
                        pa.array(likeness(own, all_cells[at + 1])),
                    ],
                    names=[column.split()[0] for column in COLUMNS.split(", ")],
                )

    return (
        rows.repartitionById(count, F.col("shard"))
        .sortWithinPartitions("shard", "guest", F.col("doc_id").desc_nulls_last(), "text")
        .mapInArrow(reported, COLUMNS)
    )


def _by_sizes(sizes: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Slices of rows whose sizes sum to the budget at most, or of one row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > budget:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
