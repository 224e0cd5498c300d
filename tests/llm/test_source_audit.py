"""Divergences between sources against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tripfold.llm import source_audit

from .conftest import CLASHING, DOCUMENT, ODD


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(rows, least):
    """(lang, source, part, item) -> (value, rank) from (text, lang, source) rows."""
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    result = {}
    for lang in {row[1] for row in rows}:
        own = [row for row in rows if row[1] == lang]
        held = Counter(term for text, _, _ in own for term in set(plain_terms(text)))
        kept = sorted((t for t, n in held.items() if n >= least), key=str.encode)
        counts = defaultdict(Counter)
        for text, _, source in own:
            counts[source].update(t for t in plain_terms(text) if held[t] >= least)

        def share(counter, term):
            return 1 + 10**9 * (counter[term] + 2) // (sum(counter.values()) + 2 * len(kept))

        whole = sum(counts.values(), Counter())
        sources = {row[2] for row in own}
        for source in sources:
            pairs = {
                other: sum(
                    (share(counts[source], t) - share(counts[other], t)) ** 2
                    // (share(counts[source], t) + share(counts[other], t))
                    for t in kept
                )
                for other in sources - {source}
            }
            leading = {}
            for t in kept:
                p, q = share(counts[source], t), share(whole, t)
                if counts[source][t] and p > q:
                    leading[t] = (p - q) ** 2 // (p + q)
            for part, values in (("pair", pairs), ("term", leading)):
                ranked = sorted(values, key=lambda item: (-values[item], item.encode()))
                for rank, item in enumerate(ranked if part == "pair" else ranked[:10], 1):
                    result[lang, source, part, item] = (values[item], rank)
    return result


def found(frame):
    return {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in frame.collect()}


def table(spark, rows):
    return spark.createDataFrame([(i, *row, 0) for i, row in enumerate(rows)], DOCUMENT)


def corpus(seed=3, documents=240):
    """Words that share prefixes of all lengths, skewed by source."""
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "ABCD", "ünïcödé", "漢字", "漢" * 30]
    words += ["pre" + "fix" * n for n in range(12)] + [f"long{'er' * n}{c}" for n in range(8) for c in "xyz"]
    rows = []
    for i in range(documents):
        source = f"s{min(rng.randrange(9), 4)}"
        bias = int(source[1]) * 7
        text = rng.choice([" ", "-", "1"]).join(
            words[(bias + int(rng.expovariate(0.1))) % len(words)] for _ in range(rng.randrange(1, 40))
        )
        rows.append((text, rng.choice(["en", "de"]), source))
    return rows


def test_against_plain_python(spark):
    rows = corpus()
    rows += [(text, "xx", "odd") for text in ODD] + [(None, None, None), ("", "", "s1"), ("1 2 3", "en", "empty")]
    documents = table(spark, rows)
    for name in (*CLASHING, "term", "prefix", "occurrences", "block", "part", "value", "blocks"):
        documents = documents.withColumn(name, documents.text)
    expected = brute(rows, 10)
    assert any(key[2] == "term" for key in expected) and ("en", "empty", "pair", "s1") in expected
    assert found(source_audit.divergences(documents)) == expected


def test_small_tables_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = corpus(seed=9, documents=120)
    expected = brute(rows, 3)
    monkeypatch.setattr(source_audit, "TABLE_ENTRIES", 5)
    monkeypatch.setattr(source_audit, "REMEMBERED", 4)
    monkeypatch.setattr(source_audit, "FIRST_WIDTH", 1)
    monkeypatch.setattr(source_audit, "CHUNK_CELLS", 8)
    monkeypatch.setattr(source_audit, "BLOCK_CELLS", 20)
    monkeypatch.setattr(source_audit, "MOST_BITS", source_audit.PIECE)
    counted = source_audit._counted  # workers read the module's own limits; a task is called here
    assert found(source_audit.divergences(table(spark, rows), 3)) == expected
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0].encode() for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])],
        names=["text", "lang", "source"],
    )
    sums = Counter()
    batches = list(counted(4, None)(iter([batch])))
    for part in batches:
        for row in part.to_pylist():
            sums[row["lang"], row["source"], row["prefix"]] += row["documents"]
    plain = Counter()
    for text, lang, source in rows:
        terms = {t.encode() for t in plain_terms(text)}
        plain.update((lang, source, t + b"\0") for t in terms if len(t) < 4)
        plain.update((lang, None, p) for p in {t[:4] for t in terms if len(t) >= 4})
    assert len(batches) > 1 and sums == plain


def test_discarded_prefixes_are_not_extended(spark):
    rows = [("common commons " + f"rareword{i} ", "en", "s") for i in range(12)]
    rows += [("onlyhere", "en", "s")] * 9
    kept = {(r.term, r.occurrences) for r in source_audit.kept_terms(table(spark, rows)).collect()}
    assert kept == {("common", 12), ("commons", 12), ("rareword", 12)}  # digits end a term


def test_empty_table_and_no_kept_terms(spark):
    assert found(source_audit.divergences(table(spark, []))) == {}
    rows = [("word", "en", "a"), ("other", "en", "b"), (None, "fr", None)]
    assert found(source_audit.divergences(table(spark, rows))) == {
        ("en", "a", "pair", "b"): (0, 1),
        ("en", "b", "pair", "a"): (0, 1),
    }


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**14), st.integers(0, 10**15)), min_size=1, max_size=20), st.integers(1, 10**9))
def test_shares_are_exact(pairs, terms):
    counts = np.array([[min(c, t)] for c, t in pairs], dtype=np.int64)
    totals = np.array([[t] for _, t in pairs], dtype=np.int64)
    for row, total in zip(counts, totals):
        expected = 1 + 10**9 * (int(row[0]) + 2) // (int(total[0]) + 2 * terms)
        assert source_audit.shares(row, total, terms)[0] == expected


def test_bitmap_of_survivors_is_read_as_written(spark):
    names = [("en", f"word{i}".encode()) for i in range(5000)] + [("", "ü".encode())]
    frame = spark.createDataFrame([(a, bytearray(b)) for a, b in names], "lang string, prefix binary")
    bits = source_audit.survivor_bits(frame, len(names))
    held = {lang: source_audit.Survivors(lang, bits) for lang in ("en", "")}
    assert all(held[lang][prefix] for lang, prefix in names)
    others = sum(held["en"][f"other{i}".encode()] for i in range(5000))
    assert others < 1000
