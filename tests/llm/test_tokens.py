from __future__ import annotations

import random

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlens.llm import packing, simple8b, token_files
from fieldlens.llm.tokens import Encoder, vocabulary_file
from fieldlens.session import fresh_path
from tests.llm import samples


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary_file())


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("aB'sé ß|.,!1 \x1c<|endoftext|>́İK", max_size=30)), max_size=6))
def test_ids_are_those_of_the_library(encoder, values):
    values = ["".join(c for c in v if not 0xD800 <= ord(c) < 0xE000) for v in values]
    counts, ids = [], []
    for c, i in encoder.encode(pa.array(values, pa.string())):
        counts += c.tolist()
        ids += i.tolist()
    wanted = [plain(encoder, v) for v in values]
    assert counts == [len(w) for w in wanted] and ids == [x for w in wanted for x in w]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 1 << 16), st.integers(0, (1 << 64) - 1)), max_size=300), st.sampled_from([1, 7, 64, 4096]), st.data())
def test_simple8b_round_trip(values, block, data):
    coded = simple8b.encode(np.array(values, dtype=np.uint64), block)
    assert simple8b.decode(coded).tolist() == values
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert simple8b.decode(coded, a, b).tolist() == values[a:b]


def test_simple8b_packs_narrow_values():
    assert len(simple8b.encode(np.ones(6000, dtype=np.uint64), 6000)) < 6000 // 7


@pytest.mark.parametrize("segment_ids", [50, 1 << 18])
def test_token_files(spark, encoder, segment_ids):
    rows = samples.rows()
    path = fresh_path(spark, "tokens")
    token_files.write_token_files(samples.clashing(samples.frame(spark, rows)), path, segment_ids=segment_ids)
    read = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for r, row in zip(read, order, strict=True):
        ids = [*plain(encoder, row[1]), 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (row[0], at, len(ids), ids)
        at += len(ids)
    digests = {r.start: r for r in token_files.token_digests(spark, path).collect()}
    assert all(digests[r.start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in read)


def test_empty_tables(spark):
    path = fresh_path(spark, "tokens")
    token_files.write_token_files(samples.frame(spark, []), path)
    assert token_files.token_digests(spark, path).collect() == []
    assert packing.pack_documents(samples.frame(spark, [])).collect() == []


def test_packing(spark, encoder):
    rows = samples.rows()
    found = packing.pack_documents(samples.clashing(samples.frame(spark, rows)), length=128, pool=50).collect()
    pieces = []
    for d, t, *_ in rows:
        ids = [*plain(encoder, t), 0]
        pieces += [(d, k, a, len(ids[a : a + 128]), zlib.crc32(np.array(ids[a : a + 128], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 128))]
    assert sorted(pieces, key=str) == sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found], key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 128
    assert len(sequences) <= 1.03 * -(-sum(p[3] for p in pieces) // 128) + 2


def test_local_search_empties_bins():
    best_fit = packing.best_fit([6, 5, 5, 4, 4, 3, 3], 10)
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]  # best fit, larger first, needs a bin more than the search
    assert len(best_fit) == 3 and len(packing.pack(sizes, 60)) <= len(packing.best_fit(sizes, 60))
    assert len(packing.pack([51, 27, 23, 23, 23, 23, 27, 53] * 5, 100)) <= len(packing.best_fit([51, 27, 23, 23, 23, 23, 27, 53] * 5, 100))
    rule = np.random.default_rng(3)
    emptied = 0
    for _ in range(60):
        sizes = rule.integers(15, 50, 40).tolist()
        bins = packing.pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(40)) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
        emptied += len(packing.best_fit(sizes, 100)) - len(bins)
    assert emptied > 0


def test_the_search_ends_only_when_no_exchange_of_any_bin_helps():
    rule = random.Random(6)
    for low, high in ((300, 1000), (600, 720), (700, 1900)):
        sizes = [rule.randint(low, high) for _ in range(400)]
        bins = packing.pack(sizes, 2048)
        assert sorted(i for b in bins for i in b) == list(range(400)) and all(sum(sizes[i] for i in b) <= 2048 for b in bins)
        assert len(bins) <= len(packing.best_fit(sizes, 2048))
        if len(bins) > -(-sum(sizes) // 2048):
            size, fill, where = np.array(sizes), np.array([sum(sizes[i] for i in b) for b in bins]), np.empty(400, dtype=np.int64)
            for b, items in enumerate(bins):
                where[items] = b
            assert not any(packing._exchange([list(b) for b in bins], size, fill.copy(), where.copy(), g, 2048) for g in range(len(bins)) if fill[g] < 2048)
