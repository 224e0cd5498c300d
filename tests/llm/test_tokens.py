from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripfold.llm import common, packing, token_files
from tripfold.llm import tokens as tokens_module
from tripfold.llm.tokens import PieceEncoder, encoder

from .conftest import CLASHING, ODD

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PARTS = ["a", "b ", "  ", "\n", " \n", "\t", "é", " ", "'s", "12", "!?", "\x1c", "<|endoftext|>", "́", " x", "\x01", "漢字", " ", "\r\n", "The", ","]


def whole(name, text):
    ids = encoder(name).library.encode(text, add_special_tokens=False).ids
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("name", NAMES)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=14), free=st.text(max_size=20))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(name, parts, free):
    for text in ("".join(parts), "".join(parts) + free, free + " " + "".join(parts)):
        assert encoder(name).encode(text) == whole(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_every_letter_of_a_plain_word(name):
    for letter in tokens_module.LETTERS:
        for text in (f"a {letter}{letter}b{letter}, x", f"{letter}tion", f"a\n{letter}the.", f"z{letter}!? a"):
            assert encoder(name).encode(text) == whole(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_white_space_of_another_kind_ends_a_piece(name):
    for text in ("a é\xa0\xa0 'b c", "a é\xa0\xa0 'b c,\n,\xa0 d", "x\x1c y\u2003 z\u2003\n."):
        assert encoder(name).encode(text) == whole(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_a_full_store_begins_anew(name, monkeypatch):
    monkeypatch.setattr(tokens_module, "STORED_PIECES", 3)
    small = PieceEncoder(name)
    for i in range(30):
        text = f"some words{i} and\nothers{i} repeat some words{i}, some"
        assert small.encode(text) == whole(name, text)
        assert len(small.stored) + len(small.stored.older) <= 2 * (4 + len(text.split()))  # two fillings


@pytest.mark.parametrize("per_shard", [3, 100])
def test_corpus_files_round_trip(spark, documents, tmp_path, per_shard):
    rows = [*enumerate(ODD), (None, "none"), (3, "word"), (3, "again"), (-5, "first")]
    random.Random(1).shuffle(rows)
    token_files.write_corpus(documents(rows, CLASHING), f"{tmp_path}/c", documents_per_shard=per_shard)
    got = token_files.read_corpus(spark, f"{tmp_path}/c").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for doc_id, text in order:
        ids = np.frombuffer(whole(NAMES[0], text or ""), "<u4").tolist() + [1]
        expected.append((doc_id, start, len(ids), ids))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids) for r in got), key=key) == expected
    sums = token_files.with_crc32(token_files.read_corpus(spark, f"{tmp_path}/c")).collect()
    assert {(r.start, r.ids_crc32) for r in sums} == {
        (s, zlib.crc32(np.array(ids, "<u4").tobytes())) for _, s, _, ids in expected
    }


def test_files_have_bloom_filters_and_prune_by_id(spark, documents, tmp_path):
    from pyarrow import orc

    token_files.write_corpus(documents([f"text {i}" for i in range(50)]), f"{tmp_path}/c", documents_per_shard=10)
    files = sorted((tmp_path / "c" / "documents").glob("*.orc"))
    assert len(files) > 1 and sum(orc.ORCFile(f).nrows for f in files) == 50
    one = token_files.read_corpus(spark, f"{tmp_path}/c").where("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_empty_corpus(spark, documents, tmp_path):
    token_files.write_corpus(documents([]), f"{tmp_path}/c")
    assert token_files.with_crc32(token_files.read_corpus(spark, f"{tmp_path}/c")).collect() == []


def test_patterns_hold_every_length_once():
    rng = random.Random(2)
    for _ in range(60):
        histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 40))}
        patterns = packing.shortest_pack_first(histogram, 64)
        placed = {}
        for lengths, count in patterns:
            assert sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True)
            for size in lengths:
                placed[size] = placed.get(size, 0) + count
        assert placed == histogram
        ranks = {}
        for size, rank, n, _, _ in packing.slots_of(patterns):
            assert rank == ranks.get(size, 0)
            ranks[size] = rank + n
        assert ranks == histogram


def test_patterns_by_hand():
    packed = packing.shortest_pack_first({6: 2, 4: 1, 2: 3}, 8)
    # 6 6 4 open three packs; the shortest, 4, takes twos first
    assert sorted(packed) == sorted([((6,), 1), ((6, 2), 1), ((4, 2, 2), 1)])
    assert packing.shortest_pack_first({}, 8) == []


def test_packing(spark, documents):
    rows = [*enumerate(ODD), (None, "none"), (3, "word"), (3, "word")] + [(100 + i, "short text " * (i % 7)) for i in range(300)]
    docs = documents(rows, CLASHING).repartition(7)
    pieces = packing.pack(docs).collect()
    sequences = {}
    for p in pieces:
        assert len(p.ids) == p.length
        sequences.setdefault(p.sequence_id, []).append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH
    texts = {}
    for p in pieces:
        texts.setdefault((p.doc_id, p.start), []).append(p.ids)
    for doc_id, text in dict(rows).items():
        ids = np.frombuffer(whole(NAMES[1], text or ""), "<u4").tolist() + [0]
        times = sum(1 for row in rows if row[0] == doc_id)
        for start in range(0, len(ids), packing.LENGTH):
            assert texts.pop((doc_id, start)) == [ids[start : start + packing.LENGTH]] * times
    assert not texts


def test_packing_an_empty_table(spark, documents):
    assert packing.with_crc32(packing.pack(documents([]))).collect() == []


def test_slices_are_bounded_by_bytes():
    """500 texts of 200,000 characters go five at a time; a longer one goes alone; no row is lost."""
    texts = ["é" * 100_000] * 500 + [None, "", "x" * 3_000_000] + ["short"] * 1200
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    slices = list(token_files.in_slices(iter([batch.slice(0, 300), batch.slice(300)])))
    assert [i for s in slices for i in s.column(0).to_pylist()] == list(range(len(texts)))
    for s in slices:
        size = sum(len((t or "").encode()) for t in s.column(1).to_pylist())
        assert s.num_rows == 1 or size <= token_files.SLICE_BYTES and s.num_rows <= token_files.SLICE_ROWS


def test_a_worker_holds_one_store_at_a_time():
    first = common.held_by_worker("one", dict)
    assert common.held_by_worker("one", dict) is first
    common.held_by_worker("two", dict)
    assert common.held_by_worker("one", dict) is not first
