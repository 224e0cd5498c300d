from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tripfold.llm import language_model as lm

from .conftest import CLASHING, ODD


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def texts(n=400, seed=2):
    """Two kinds of texts, each with words of its own, and a long tail."""
    rng = random.Random(seed)
    kinds = [[f"{a}{i}" for i in range(150)] for a in ("al", "be")]
    rare = lambda k: f"rare{rng.randint(0, 400)}{'xy'[k]}"
    result = []
    for _ in range(n):
        k = rng.randint(0, 1)
        pick = lambda: rng.choice(kinds[k][: rng.choice((3, 30, 150))])
        result.append(" ".join(rare(k) if rng.random() < 0.2 else pick() for _ in range(rng.randint(5, 60))))
    return result


@pytest.mark.parametrize("head", [0, 40, 300, 100_000])
def test_base_score_counts_and_gain(spark, documents, monkeypatch, head):
    plain = lm.vocabulary_of
    monkeypatch.setattr(lm, "vocabulary_of", lambda counts: plain(counts, head))
    rows = [*enumerate(ODD[:5] + ODD[7:]), (None, "al1 al2"), (3, "word"), *((100 + i, t) for i, t in enumerate(texts(3000)))]
    docs = documents(rows, CLASHING).repartition(3)
    learning = docs.where("doc_id IS NULL OR doc_id % 4 <> 0")
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or doc_id % 4:
            counts.update(plain_tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    got = lm.score_corpus(docs, learning).collect()
    assert len(got) == len(rows)
    expected = sorted(
        (str(doc_id), len(plain_tokens(t)), sum(counts[w] > 0 for w in plain_tokens(t)),
         round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in plain_tokens(t)), 6))
        for doc_id, t in rows
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert {r.train_tokens for r in got} == {total}
    held = [r for r in got if r.doc_id and r.doc_id >= 100 and r.doc_id % 4 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one(spark, documents):
    counts = lm.word_counts(documents(texts(60))).cache()
    vocabulary = lm.vocabulary_of(counts)
    model = lm.trained(documents(texts(60)), vocabulary)
    size = len(vocabulary.share)
    before = np.array([[5], [size], [size]])
    p = np.exp([model.log_probability(np.array([k]), before)[0] for k in range(size)])
    assert abs(p.sum() - 1) < 1e-4
    # within each class: known words and the room for unknown ones
    words = {r.word: r.n for r in counts.collect()}
    inside, room = np.zeros(size), np.zeros(size)
    top = set(sorted(words, key=lambda w: (-words[w], w))[: lm.WORDS])
    for word, n in words.items():
        k = vocabulary.endings.get(lm.ending(word), size - 1)
        if word not in top:
            inside[k] += n + lm.SMOOTHING
    room[lm.WORDS :] = inside[lm.WORDS :] + lm.SMOOTHING
    held = room > lm.SMOOTHING
    assert np.allclose(np.log10(room[held]), vocabulary.class_log_total[held])


def test_the_loss_falls_while_learning():
    share = np.full(lm.WORDS + lm.CLASSES, 1 / (lm.WORDS + lm.CLASSES))
    output = np.tile(np.arange(10), 4000)
    model = lm.Model.fresh(share)
    before = lm.contexts_of(output, np.array([len(output)]), len(share))
    start = model.log_probability(output[:100], before[:, :100]).mean()
    lm.Trainer(model, share, 1).learn(output, before)
    assert model.log_probability(output[:100], before[:, :100]).mean() > start + 1


def test_empty_tables(documents):
    assert lm.score_corpus(documents([]), documents([])).collect() == []
    rows = lm.score_corpus(documents(["a b", None]), documents([])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 0, 0), (3, 0, 0)]
