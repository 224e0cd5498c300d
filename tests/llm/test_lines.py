from __future__ import annotations

import random

from tripfold.llm import lines

from .conftest import CLASHING, DOCUMENT, ODD


def brute(rows, min_sites):
    """rows: (doc_id, text, source), ids distinct."""
    sites, first = {}, {}
    for doc_id, text, source in rows:
        for at, part in enumerate((text or "").split("\n")):
            line = part.strip(" \t\r")
            if line:
                sites.setdefault(line, set()).add(source)
                first[line] = min(first.get(line, (doc_id, at)), (doc_id, at))
    result = {}
    for doc_id, text, _ in rows:
        if text is None:
            result[doc_id] = None
            continue
        kept = []
        for at, part in enumerate(text.split("\n")):
            line = part.strip(" \t\r")
            if not line or len(sites[line]) < min_sites or first[line] == (doc_id, at):
                kept.append(part)
        result[doc_id] = "\n".join(kept)
    return result


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCUMENT)


def test_agrees_with_brute_force(spark):
    rng = random.Random(8)
    shared = [f"shared line {i}" for i in range(30)]
    rows = []
    for i in range(300):
        parts = [rng.choice([rng.choice(shared), f"own {i} {k}", "", "  "]) for k in range(rng.randint(0, 9))]
        parts = [part + rng.choice(["", " ", "\r"]) for part in parts]
        rows.append((i, rng.choice(["\n".join(parts)] * 9 + [None]), rng.choice(["a", "b", "c", "d", "e", None])))
    for min_sites in (2, 3, 5):
        got = lines.without_boilerplate(table(spark, rows), min_sites).collect()
        assert {r.doc_id: r.text for r in got} == brute(rows, min_sites)


def test_many_sites_are_estimated_and_the_threshold_is_exact(spark):
    rows = [(i, f"often\nown {i}", f"site{i}") for i in range(400)]
    rows += [(1000 + i, "just enough", f"site{i}") for i in range(100)]
    rows += [(2000 + i, "one too few", f"site{i % 99}") for i in range(300)]
    got = {r.doc_id: r.text for r in lines.without_boilerplate(table(spark, rows), 100).collect()}
    assert got == brute(rows, 100)


def test_odd_rows_and_names(spark, documents):
    docs = documents([*enumerate(ODD), (None, "a\nb"), (None, "a\nb"), (8, ODD[8])], (*CLASHING, "n_removed"))
    got = lines.without_boilerplate(docs, min_sites=2)
    assert got.columns == [*docs.columns, "n_lines_", "n_removed_"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert {r.text for r in rows if r.doc_id == 0} == {None}
    assert {(r.n_lines_, r.n_removed_) for r in rows if r.doc_id in (0, 1)} == {(0, 0), (1, 0)}
    # the two rows of document 9 say the same as 8, from another source: one occurrence stays
    assert sorted(r.text for r in rows if r.doc_id in (8, 9)) == ["", ODD[8], ODD[8]]


def test_empty_table(spark, documents):
    assert lines.without_boilerplate(documents([])).collect() == []
