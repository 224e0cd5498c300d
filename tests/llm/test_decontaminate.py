from __future__ import annotations

import random
import re
from math import ceil

import duckdb
import pandas as pd
import pytest

from tripfold.llm import decontaminate
from tripfold.llm.queries import ORACLE

from .conftest import CLASHING, ODD

ITEM = "item_id bigint, text string"


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(text, n=5):
    words = words_of(text)
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(docs, items, threshold=0.8):
    found = set()
    for doc_id, text in docs:
        for item_id, item in items:
            wanted = shingles(item)
            own = shingles(text, min(5, max(1, len(words_of(item)))))
            if wanted and len(own & wanted) >= ceil(threshold * len(wanted) - 1e-9):
                found.add((doc_id, item_id, len(own & wanted), len(wanted)))
    return found


def run(spark, frame, items, **options):
    pairs = decontaminate.contained_items(frame, spark.createDataFrame(items, ITEM), **options)
    return {(r.doc.id, r.item.id, r.shared, r.item_shingles) for r in pairs.collect()}


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_agrees_with_brute_force(spark, documents, threshold):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 6, 12, 30, 57]))) for i in range(40)]
    docs = []
    for i in range(120):
        parts = [text(rng.randint(0, 200))]
        if i % 2:
            item = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                item[rng.randrange(len(item))] = "changed"
            parts += [" ".join(item).upper(), text(rng.randint(0, 100))]
        docs.append((i, "  ".join(parts)))
    docs += [(500, items[0][1]), (501, items[0][1] + "!")]
    expected = brute(docs, items, threshold)
    assert expected
    assert run(spark, documents(docs), items, threshold=threshold) == expected


def test_odd_rows(spark, documents):
    items = [(1, ODD[4]), (2, None), (3, ""), (None, "word"), (1, "word"), (4, "--"), (1, ODD[4])]
    docs = [*enumerate(ODD), (None, ODD[4]), (4, ODD[4])]
    got = run(spark, documents(docs, CLASHING), items)
    assert got == brute(docs, items)
    assert (None, 1, 7, 7) in got and (3, None, 1, 1) in got


def test_short_items_in_long_documents(spark, documents):
    rng = random.Random(8)
    long = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    planted = long[:9000] + ["Three,", "short", "words"] + long[9000:]
    items = [(1, "three short words"), (2, "short three words"), (3, "words"), (4, "w1 w2 w3 w4 w5 w6")]
    docs = [(1, " ".join(planted)), (2, " ".join(long)), (3, "short words"), (4, "three short"), (5, "words words")]
    got = run(spark, documents(docs), items)
    assert got == {(1, 1, 1, 1), (1, 3, 1, 1), (3, 3, 1, 1), (5, 3, 1, 1)}
    # the SQL of the query finds the same
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    duck.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    rows = duck.sql(f"SELECT doc_id, item_id, shared, item_shingles FROM ({ORACLE['op1_decontamination']})")
    assert set(rows.fetchall()) == got


def test_empty_tables(spark, documents):
    assert run(spark, documents([]), [(1, "a b c")]) == set()
    assert run(spark, documents(["a b c"]), []) == set()


def test_contaminated_documents_go_with_their_text(spark, documents):
    docs = documents([(1, "a b c d e f"), (1, "clean"), (None, "a b c d e f"), (2, None)], CLASHING)
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame([(1, "b c d e f")], ITEM))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "clean"), (2, None)]


def test_no_python_in_the_plan(spark, documents):
    pairs = decontaminate.contained_items(
        documents(["a b c d e f"]), spark.createDataFrame([(1, "a b c d e")], ITEM)
    )
    plan = pairs._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
