"""The audit against filters applied one after the other, and Shapley values by definition."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripfold.llm import filter_audit

from .conftest import CLASHING, DOCUMENT, ODD


def fails(text: str) -> set[str]:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    found = set()
    if len(words) < 50:
        found.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        found.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        found.add("C")
    if re.search("[#$%&*|]", text):
        found.add("D")
    return found


def brute(rows, labels):
    """Every order applied to the documents, filter by filter."""
    rows = [(doc_id, text or "", source or "") for doc_id, text, source in rows]
    failing = []
    for doc_id, text, _ in rows:
        earlier = any(
            other is not None and doc_id is not None and other < doc_id and same == text
            for other, same, _ in rows
        )
        failing.append(fails(text) | ({"E"} if earlier else set()))
    good = {doc_id for doc_id, quality, _ in labels if quality == 1 and doc_id is not None}
    toxic = {doc_id for doc_id, _, mark in labels if mark == 1 and doc_id is not None}
    result, summed = {}, Counter()
    for part in {source for _, _, source in rows}:
        for order in permutations("ABCDE"):
            left = [i for i, row in enumerate(rows) if row[2] == part]
            for step, name in enumerate(order, 1):
                lost = [i for i in left if name in failing[i]]
                left = [i for i in left if name not in failing[i]]
                own = [i for i, row in enumerate(rows) if row[2] == part and name in failing[i]]
                result[part, "".join(order), step] = (
                    len(left),
                    len(lost),
                    len(own) - len(lost),
                    sum(failing[i] == {name} for i in own),
                    sum(rows[i][0] in good for i in lost),
                    sum(rows[i][0] in toxic for i in lost),
                )
                summed[part, name] += len(lost)
    return {key: (*value, summed[key[0], key[1][key[2] - 1]]) for key, value in result.items()}


def rows_of(frame):
    return {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in frame.collect()
    }


LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    *ODD,
    LONG,
    LONG,
    LONG + " #",
    LONG.upper(),
    "same " * 60,
    "SAME " * 60 + "$",
    " ".join(f"w{i % 32}" for i in range(50)),  # 64 % distinct
    " ".join(f"w{i % 33}" for i in range(50)),  # 66 %
    "A" + "b" * 19,  # exactly 5 % capitals
    "A" + "b" * 18,
]


def test_against_filters_in_turn(spark):
    rows = [(i, text, f"s{i % 3}") for i, text in enumerate(TEXTS)]
    rows += [(3, LONG, None), (3, LONG, ""), (3, LONG, "s1"), (None, LONG, "s1"), (None, None, "s2"), (40, None, None)]
    labels = [(i, i % 2, (i + 1) % 2) for i in range(0, 20, 3)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (9, None, None)]
    documents = spark.createDataFrame(
        [(i, text, "en", source, 0) for i, text, source in rows], DOCUMENT
    )
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for name in (*CLASHING, "n", "fails", "part", "is_first"):
        documents = documents.withColumn(name, documents.text)
        known = known.withColumn(name, known.quality)
    assert rows_of(filter_audit.audit(documents, known)) == brute(rows, labels)


def test_one_text_in_most_rows(spark):
    rows = [(i, LONG if i % 3 else None, "s") for i in range(3000)]
    documents = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCUMENT)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = rows_of(filter_audit.audit(documents, labels))
    assert found["s", "EABCD", 1][:2] == (2, 2998)
    assert found["s", "AEBCD", 1][:4] == (2000, 1000, 0, 1)
    assert found["s", "AEBCD", 2][:4] == (1, 1999, 999, 1999)


def test_empty_tables(spark):
    documents = spark.createDataFrame([], DOCUMENT)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(documents, labels).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 10**12), min_size=32, max_size=32))
def test_shapley_values_by_definition(counts):
    removals = filter_audit.coalition_removals(counts)
    total = [Fraction(0)] * 5
    for order in permutations(range(5)):
        before = 0
        for i in order:
            total[i] += removals[before | 1 << i] - removals[before]
            before |= 1 << i
    assert filter_audit.shapley_values(removals) == [value / 120 for value in total]


@pytest.mark.parametrize("players", [2, 3, 4])
def test_shapley_values_of_fewer_players(players):
    removals = [bin(members).count("1") ** 2 for members in range(2**players)]
    assert filter_audit.shapley_values(removals) == [Fraction(players)] * players
