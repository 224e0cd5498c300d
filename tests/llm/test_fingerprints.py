from __future__ import annotations

import hashlib
import random
import string

import numpy as np
import pytest

from tripfold.llm import fingerprints as fp

from .conftest import CLASHING, ODD

RNG = random.Random(5)


def prose(words):
    return " ".join("".join(RNG.choice(string.ascii_lowercase) for _ in range(RNG.randint(1, 9))) for _ in range(words))


def test_texts_parsed_together_or_alone_are_the_same():
    texts = [text or "" for text in ODD] + [prose(n) for n in (1, 2, 5, 40, 300)] + ["aaaa", "aaab", "ab" * 50]
    together = fp.fingerprints_of(texts)
    for text, cells in zip(texts, together):
        assert (fp.fingerprints_of([text])[0] == cells).all()
    assert not together[0].any()
    assert (together[8] == together[9]).all()


def test_equal_substrings_share_names_whatever_their_offset():
    shared = prose(400)
    alike = []
    for _ in range(20):
        left, right = prose(RNG.randint(1, 60)) + shared, shared + prose(RNG.randint(1, 60))
        cells = fp.fingerprints_of([left, right])
        alike.append(fp.likeness(cells[:1], cells[1:])[0])
    assert np.mean(alike) > 0.7


def test_edited_texts_are_half_alike_and_strangers_are_not():
    texts = [prose(RNG.randint(100, 500)) for _ in range(60)]
    edited = [fp.edited_text(a, b) for a, b in zip(texts, texts[1:])]
    cells, other = fp.fingerprints_of(texts), fp.fingerprints_of(edited)
    assert 0.4 < np.mean(fp.likeness(cells[:-1], other)) < 0.65
    assert np.mean(fp.likeness(cells[:-1], cells[1:])) < 0.1


def test_likeness_of_empty_texts():
    cells = fp.fingerprints_of(["", "", "x"])
    assert fp.likeness(cells[:2], cells[1:]).tolist() == [1.0, 0.0]


@pytest.mark.parametrize("per_shard", [3, 1000])
def test_report(spark, documents, per_shard):
    rows = [*enumerate(ODD), (None, "none"), (3, "word"), (3, "again"), (-5, prose(80)), (40, prose(500))]
    rows += [(50 + i, prose(i)) for i in range(25)]
    got = fp.edit_report(documents(rows, CLASHING).repartition(5), per_shard).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        own, other, after = (fp.fingerprints_of([t]) for t in (text, edited, following))
        expected.append(
            (str(doc_id), n, hashlib.sha256(edited.encode()).hexdigest(), fp.as_hex(own)[0], fp.as_hex(other)[0],
             fp.likeness(own, other)[0], fp.likeness(own, after)[0])
        )
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(expected)


@pytest.mark.parametrize("rows", [[], [(1, "only one document here")], [(None, "a"), (None, "b")]])
def test_few_rows(documents, rows):
    got = fp.edit_report(documents(rows)).collect()
    assert len(got) == len(rows)
