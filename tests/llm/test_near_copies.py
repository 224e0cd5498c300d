from __future__ import annotations

import random

import pytest

from tripfold.llm import near_copies as nc
from tripfold.llm import simhash

from .conftest import CLASHING, ODD
from .test_simhash import close, groups_of, plain_print


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def kept_of(rows):
    sets = [plain_set(text) for _, text in rows]
    distinct = sorted(set(sets), key=sorted)
    links = [
        (i, j)
        for i, a in enumerate(distinct)
        for j, b in enumerate(distinct[:i])
        if 5 * len(a & b) >= 4 * len(a | b)
    ]
    groups = groups_of(range(len(distinct)), links)
    least = {}
    for (doc_id, _), own in zip(rows, sets):
        root = groups[distinct.index(own)]
        least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(least.values())


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("common", [0, 200_000])
def test_no_pair_is_missed(documents, monkeypatch, common):
    monkeypatch.setattr(nc, "COMMON", common)
    rng = random.Random(5)
    passage = [f"common{i}" for i in range(30)]
    texts = [*ODD]
    for group in range(25):
        base = [f"w{group}x{i}" for i in range(rng.randint(6, 200))] + passage * (group % 2)
        texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(rng.randint(1, 6))]
        texts.append(" ".join(base))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = documents(rows, CLASHING).repartition(3)
    kept = nc.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == kept_of(rows)


def test_the_stage_finds_copies_four_bits_miss(spark, documents):
    import corpus_pipeline

    rng = random.Random(18)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base)), (1, edited(rng, base, 2)), (2, " ".join(f"v{i}" for i in range(100)))]
    assert close([plain_print(text) for _, text in rows], 4) == []
    assert kept_of(rows) == [0, 2]
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, documents(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_a_chain_of_copies_is_one_group(documents):
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[2 * i :] + [f"e{j}" for j in range(2 * i)])) for i in range(8)]
    assert kept_of(rows) == [0]
    assert [r.doc_id for r in nc.one_of_each(documents(rows)).collect()] == [0]


def test_repeated_rows_and_empty_tables(documents):
    kept = nc.one_of_each(documents([(7, "a b c d e"), (7, "a b c d e"), (None, "q r"), (None, "q r")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("7", "a b c d e"), ("None", "q r")]
    assert nc.one_of_each(documents([])).collect() == []


def test_fingerprints_in_vantage_point_trees_give_candidates(documents, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*base[:-1], f"end{i}"])) for i in range(4)] + [(9, edited(rng, base, 8))]
    found = []

    def links_of(prints):
        found.append(simhash.close_links(prints).distinct().count())
        return simhash.close_links(prints)

    monkeypatch.setattr(nc, "close_links", links_of)
    assert sorted(r.doc_id for r in nc.one_of_each(documents(rows)).collect()) == kept_of(rows)
    assert found and found[0] > 0


def test_only_a_shingle_that_may_be_the_first_makes_a_pair(spark):
    rows = [(100, 100, 11, 11), (100, 100, 12, 11), (100, 100, 0, 12), (100, 125, 20, 25), (100, 125, 0, 26)]
    frame = spark.createDataFrame(rows, "n_a bigint, n_b bigint, place_a int, place_b int")
    # overlap 89 of sets of 100 and 100; 100 of 100 and 125
    assert [r[0] for r in frame.select(nc._first(0.8)).collect()] == [True, False, False, False, False]
    fits = spark.createDataFrame([(100, 125, 0, 25)], frame.schema)
    assert fits.where(nc._first(0.8)).count() == 1
