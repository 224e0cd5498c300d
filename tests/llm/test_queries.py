"""The registered queries over the smallest tables, and the pipeline against plain Python."""

from __future__ import annotations

import re

import pytest
from oracle_check import connect, duck_side, spark_side, type_differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tripfold.llm.common import staged
from tripfold.llm.queries import ORACLE, QUERIES

from .conftest import ODD
from .test_decontaminate import brute as contaminated
from .test_lines import brute as cut_lines
from .test_near_copies import kept_of as near_copies_kept


def test_all_are_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= queries().keys()
    assert ORACLE.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_oracle(spark, sf_dir, name):
    frame, duck = QUERIES[name](spark, sf_dir), connect(sf_dir)
    assert spark_side(frame) == duck_side(duck, ORACLE[name])
    assert type_differences(frame, duck, ORACLE[name]) == []


def test_stages_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = staged(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language":
            assert after.keys() == {r.doc_id for r in before if any(map(str.isalpha, r.text or ""))}
        elif name == "line_dedup":
            expected = cut_lines([(r.doc_id, r.text, r.source) for r in before], 3)
            assert {i: r.text for i, r in after.items()} == expected
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_dedup":
            assert sorted(after) == near_copies_kept([(r.doc_id, r.text) for r in before])
        elif name == "decontamination":
            hit = {pair[0] for pair in contaminated([(r.doc_id, r.text) for r in before], items)}
            assert hit and after.keys() == {r.doc_id for r in before} - hit
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)


def test_odd_documents_pass_the_pipeline(spark, sf_dir, documents):
    docs = documents([*enumerate(ODD), (None, "the end of it"), (None, "the end of it")], ("hash", "label"))
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "odd")
    assert docs.count() > 0
