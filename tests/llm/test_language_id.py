from __future__ import annotations

import random
import tracemalloc

import numpy as np

from tripfold.llm import language_id as li

from .conftest import CLASHING, DOCUMENT, ODD

WORDS = {
    "en": "the of and to in is that for was with as on are this have from which were their been".split(),
    "de": "der die und das ist nicht mit sich auf dem für eine wird auch einen über schon können".split(),
    "fr": "le la les des est dans qui pour une avec sur pas être était très même où déjà leur nous".split(),
}


def text(rng, language, n):
    return " ".join(rng.choice(WORDS[language]) + rng.choice(["", "", ","]) for _ in range(n))


def sample(seed=1, n=60):
    rng = random.Random(seed)
    return [(text(rng, language, rng.randint(5, 60)), language) for language in WORDS for _ in range(n)]


def plain_marginals(emission, transitions):
    forward, step = [np.exp(emission[0])], np.exp(transitions)
    for row in emission[1:]:
        forward.append((forward[-1] @ step) * np.exp(row))
        forward[-1] /= forward[-1].sum()
    backward = [np.ones(len(step))]
    for row in emission[:0:-1]:
        backward.insert(0, step @ (np.exp(row) * backward[0]))
        backward[0] /= backward[0].sum()
    p = np.array(forward) * np.array(backward)
    return p / p.sum(axis=1, keepdims=True)


def test_forward_backward_in_blocks_is_exact():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, 130, 255, 256, 257, 700, 2])
    emission, transitions = rng.normal(size=(sizes.sum(), 3)), rng.normal(size=(3, 3))
    got = li.marginals(emission, sizes, transitions)
    for own, part in zip(np.split(emission, np.cumsum(sizes)[:-1]), np.split(got, np.cumsum(sizes)[:-1])):
        assert np.allclose(plain_marginals(own, transitions), part)


def test_held_out_accuracy_and_code_switching():
    model = li.trained(sample())
    assert (np.diag(model.transitions) > model.transitions.max(axis=1) - 1e-9).all()
    found, certain = [], []
    tests = sample(seed=9, n=30)
    li._decide([li.words_of(t) for t, _ in tests], model, li.WordScores(model), found, certain)
    assert np.mean([a == b for a, (_, b) in zip(found, tests)]) > 0.97
    rng = random.Random(4)
    mixed = text(rng, "en", 20) + " " + text(rng, "de", 20)
    labels = [label for _, label, _ in li.word_languages(mixed, model)]
    assert labels[:18].count("en") >= 17 and labels[-18:].count("de") >= 17


def test_documents(spark, documents):
    model = li.trained(sample())
    model.name = "test"
    rows = [*enumerate(ODD), (None, "the of and"), (20, "12 34 !?"), (21, "der und nicht mit " * 5)]
    got = li.identify(documents(rows, CLASHING), model).collect()
    assert len(got) == len(rows)
    for row, (doc_id, value) in zip(sorted(got, key=str), sorted(rows, key=str)):
        assert 0 <= row.score <= 1
    by_id = {r.doc_id: r for r in got}
    for doc_id in (0, 1, 2, 20):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[21].lang_pred == "de" and by_id[None].lang_pred == "en"
    kept = li.with_language(documents(rows, CLASHING), model)
    assert {0, 1, 2, 20}.isdisjoint(r.doc_id for r in kept.collect())
    assert kept.where("doc_id IS NULL").count() == 1


def test_sample_is_bounded_and_training_sees_only_its_rows(spark):
    rows = [(i, t, language, "s", 1) for i, (t, language) in enumerate(sample())]
    rows += [(9999, "zz zz zz", None, "s", 1), (9998, None, "en", "s", 1), (9997, "12", "en", "s", 1)]
    table = spark.createDataFrame(rows, DOCUMENT)
    chosen = li.sampled(table, 7)
    assert sorted(language for _, language in chosen) == sorted(["en", "de", "fr"] * 7)
    assert set(chosen) <= {(t, language) for _, t, language, _, _ in rows if language}


def test_without_labels_or_rows(spark, documents):
    empty = documents([])
    model = li.fitted(empty)
    assert li.identify(empty, model).collect() == []
    assert [(r.lang_pred, r.score) for r in li.identify(documents(["the"]), model).collect()] == [("und", 0.0)]
    one = li.fitted(documents(["the word"]))
    assert [(r.lang_pred, r.score) for r in li.identify(documents(["the"]), one).collect()] == [("en", 1.0)]


def test_unlearned_languages_and_letter_noise_are_rejected(documents):
    rng = random.Random(6)
    model = li.trained([row for row in sample(n=100) if row[1] != "fr"])
    model.name = "two languages"
    clean = [text(rng, language, n) for language in ("en", "de") for n in (1, 2, 5, 20, 200) for _ in range(10)]
    clean += [text(rng, "en", n) + " " + text(rng, "de", n) for n in (1, 3, 20)]
    foreign = [text(rng, "fr", n) for n in (40, 200)]
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz   ") for _ in range(n)) for n in (60, 300, 3000)]
    rows = list(enumerate(clean + foreign + noise))
    kept = {r.doc_id for r in li.with_language(documents(rows), model).collect()}
    assert kept == set(range(len(clean)))


def test_one_language_can_reject():
    model = li.trained([(t, language) for t, language in sample(n=100) if language == "en"]).with_spelling()
    rng, fit = random.Random(8), []
    texts = [li.words_of(t) for t in (text(rng, "en", 30), "zq xvj qqk wzzx " * 10, text(rng, "de", 60))]
    li._decide(texts, model, li.WordScores(model, True), [], [], fit)
    assert fit == [True, False, False]


def test_only_letters_make_words():
    assert li.words_of("x² ½ Ⅷ 3 _ Straße, l\u0301été") == ["x", "straße", "l", "été"]
    assert [li.words_of(text) for text in ("²", "½", "Ⅷ", "12", "")] == [[]] * 5
    run = "語" * 95
    assert li.words_of(f"a {run}") == ["a", run[:40], run[:40], run[:15]]


def test_sample_is_the_least_by_hash(spark, documents):
    rows = [(i, f"text {'abcdefghij'[i % 10]} {'x' * (i % 997)}", "de" if i % 7 else "fr") for i in range(6000)]
    rows += [(9000, None, "de"), (9001, "12", "de"), (9002, "only one", "it"), (9003, "no label", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").cache()
    hashed = frame.selectExpr("text", "lang", "xxhash64(text) AS h").distinct().collect()
    expected = []
    for lang in ("de", "fr", "it"):
        own = sorted((r.h, r.text) for r in hashed if r.lang == lang and r.text and any(map(str.isalpha, r.text)))
        expected += [(text, lang) for _, text in own[:50]]
    assert li.sampled(frame, 50) == sorted(expected)
    assert li.sampled(frame.limit(0), 50) == []


def test_held_out_texts_are_scored_in_slices(monkeypatch):
    whole, at_once, marginals = li.trained(sample()).with_spelling().spelling, [], li.marginals
    monkeypatch.setattr(li, "FITTED_WORDS", 300, raising=False)
    monkeypatch.setattr(li, "marginals", lambda e, *rest: at_once.append(len(e)) or marginals(e, *rest))
    sliced = li.trained(sample()).with_spelling().spelling
    assert max(at_once) <= 300
    assert np.allclose(sliced.floor, whole.floor, rtol=1e-12) and (sliced.table == whole.table).all()
    assert sum(map(len, li._sliced([np.zeros(n) for n in (5, 900, 1, 299, 1)], 300))) == 5


def test_fitting_holds_the_sample_once_and_a_slice_of_scores():
    rng = random.Random(2)
    texts = [(text(rng, language, 1000), language) for language in WORDS for _ in range(50)]
    tracemalloc.start()
    try:
        model = li.trained(texts, epochs=1)
        kept = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        model.with_spelling()
        fitting = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert kept < 4e6 and fitting < 16e6
    assert model.texts is None and model.vocabulary is None
