from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tripfold.llm import simhash
from tripfold.llm.components import components

from .conftest import CLASHING, ODD


def plain_print(text):
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(part, 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_of(nodes, links):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def close(values, radius):
    return [
        (a, b) for i, a in enumerate(values) for b in values[:i] if (int(a) ^ int(b)).bit_count() <= radius
    ]


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def test_fingerprints_follow_their_definition():
    for text in [*ODD[:5], *ODD[7:], "a b", "A  b\tC d\nE", "É é", "the " * 9 + "End"]:
        assert simhash.fingerprint_of(text or "") == plain_print(text)


def clustered(rng, clusters, far):
    values = set()
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            value = centre
            for _ in range(rng.randint(0, far)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize("leaf_rows,block_rows", [(1000, 16_000), (20, 16_000), (40, 13)])
def test_components_agree_with_all_pairs(spark, leaf_rows, block_rows):
    values = clustered(random.Random(3), 350, 5)
    frame = spark.createDataFrame([(signed(v),) for v in values], "print bigint")
    links = simhash.close_links(frame, 4, leaf_rows, block_rows)
    got = [(r.a, r.b) for r in links.collect()]
    as_unsigned = [(a % (1 << 64), b % (1 << 64)) for a, b in got]
    assert all((a ^ b).bit_count() <= 4 for a, b in as_unsigned)
    assert groups_of(values, as_unsigned) == groups_of(values, close(values, 4))


def test_a_dense_group_leaves_few_links():
    rng = np.random.default_rng(1)
    values = np.unique(np.uint64(1) << rng.integers(0, 60, 500).astype(np.uint64) | rng.integers(0, 4, 500).astype(np.uint64))
    links = simhash.spanning_links(values, values[:0], True, 6)
    assert len(links) == len(values) - 1


def test_visitors_meet_all_at_home_whatever_their_place():
    rng = np.random.default_rng(3)
    home = rng.integers(0, 1 << 63, 70).astype(np.uint64)
    visitors = np.concatenate([home[:50] ^ np.uint64(5), rng.integers(0, 1 << 63, 90).astype(np.uint64)])
    links = {tuple(link) for link in simhash.spanning_links(home, visitors, True, 4).tolist()}
    assert links == {(int(h) ^ 5, int(h)) for h in home[:50]}


def test_trees_route_every_close_pair_to_one_leaf():
    rng = np.random.default_rng(2)
    tree = simhash.vantage_tree(rng.integers(0, 1 << 16, 5000).astype(np.uint32), 7, rng)
    homes, offsets, visits, leaves = simhash.leaves_of_tree(tree, 1)
    assert leaves > 50
    for value in rng.integers(0, 1 << 16, 300):
        for bit in range(16):
            other = value ^ (1 << bit)
            low, high = sorted((value, other), key=lambda v: homes[v])
            own = visits[offsets[low] : offsets[low + 1]]
            assert homes[low] == homes[high] or homes[high] in own


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, i) for i in range(1001, 1400)]
    loops = [(5000, 5000), (301, 301)]
    found = components(spark.createDataFrame(chain + hub + loops + chain[:5], "a bigint, b bigint"))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1400), 1000)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_documents(spark, documents):
    base = "The quick brown fox jumps over the lazy dog near the river bank while it rains. " * 6
    rows = [*enumerate(ODD), (None, base), (20, base), (20, base), (19, base + " End"), (30, "Same TEXT here with two lines")]
    frame = documents(rows, CLASHING)
    got = simhash.near_duplicates(frame).collect()
    prints = [plain_print(text) for _, text in rows]
    groups = groups_of(sorted(set(prints)), close(sorted(set(prints)), 4))
    least = {}
    for (doc_id, _), value in zip(rows, prints):
        if doc_id is not None:
            least[groups[value]] = min(doc_id, least.get(groups[value], doc_id))
    expected = sorted((str(d), p, least[groups[p]]) for (d, _), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.print % (1 << 64), r.component_id) for r in got) == expected
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_repeated_rows_leave_one(documents):
    kept = simhash.one_of_each(documents([(7, "a b c d e"), (7, "a b c d e"), (None, "q r"), (None, "q r")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("7", "a b c d e"), ("None", "q r")]


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.one_of_each(documents([])).collect() == []
