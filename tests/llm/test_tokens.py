"""Packing and token files against the tokenizers library and plain references."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketframe.llm import simple8b
from marketframe.llm.arrow import shared_path
from marketframe.llm.packing import CapacityTree, best_fit_decreasing, pack_documents
from marketframe.llm.token_files import read_token_files, write_token_files
from marketframe.llm.token_ids import ChunkEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "Hello, world! it's  don't 'something' ''s 've\n\n x\t y", "São Ñandú élan ÀÉ ²½ªº µm", "日本語 text Ωmega Σς", "a" * 5000,
         "zero​width nb\xa0sp \x85 soft\xadhyphen \x1c sep", "<|endoftext|> and <|startoftext|>", "a <|endoftext|> b <|startoftext|>", "A<|ENDOFTEXT|> <|endoftext|", "é <|endoftext|>\n\n日本", "  lead", "trail  ", "1234 5,6.7 $$$ *** a1b2", "I'LL WE'Re o'clock", "İstanbul ﬁ é"]


def reference(path, texts):
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("cache", [3, 100_000])
def test_encoder_equals_library(path, cache):
    got = ChunkEncoder(path, cache).encode(TEXTS)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == reference(path, TEXTS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abZ' \n\t.,1é²ñ\xa0\xad_-Ω", "<|endoftext|>", "<|"]), max_size=30).map("".join), max_size=4))
def test_encoder_equals_library_on_any_text(texts):
    for path in (WORDS, BYTES):
        e = _kept.setdefault(path, ChunkEncoder(path))
        assert [np.frombuffer(g, "<u4").tolist() for g in e.encode(texts)] == reference_kept(path, texts)


_kept, _lib = {}, {}


def reference_kept(path, texts):
    if path not in _lib:
        _lib[path] = Tokenizer.from_file(path)
    return [_lib[path].encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300), st.sampled_from([1, 7, 64, 8192]))
def test_simple8b_round_trip(values, block):
    coded = simple8b.encode(np.array(values, np.uint64), block)
    assert simple8b.decode(*coded, len(values), block).tolist() == values
    blocks = len(coded[2])
    if blocks > 1:
        assert simple8b.decode(*coded, len(values), block, (1, 2)).tolist() == values[block: 2 * block]


def test_simple8b_is_compact():
    assert len(simple8b.encode(np.ones(6000, np.uint64))[0]) == 8 * 100


def naive_best_fit(lengths, size):
    room, out = [], []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            room[room.index(min(fits))] -= lengths[i]
        else:
            room.append(size - lengths[i])
    return sorted(room)


def test_best_fit_equals_naive():
    rng = random.Random(1)
    for _ in range(60):
        size = rng.choice([1, 7, 64, 100])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 80))]
        placed = best_fit_decreasing(lengths, size)
        used = {}
        for i, w, at in sorted(placed, key=lambda p: (p[1], p[2])):
            assert used.get(w, 0) == at
            used[w] = at + lengths[i]
        assert sorted(size - u for u in used.values()) == naive_best_fit(lengths, size)
    tree = CapacityTree(5)
    assert tree.take_tightest(0) is None


def rows(spark):
    data = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "no id", None), (99, "word " * 9000, "long")]
    return data, spark.createDataFrame(data, "doc_id long, text string, ids string").repartition(3)


def test_pack_documents(spark):
    data, docs = rows(spark)
    got = pack_documents(docs, WORDS, 1).collect()
    expected = {(d, tuple([*ids, 1])) for (d, _, _), ids in zip(data, reference(WORDS, [t for _, t, _ in data]))}
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert len(r.ids) == 4 * r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    joined = set()
    for (doc, n), parts in pieces.items():
        copies = 2 if doc == 3 else 1
        by_start = {r.start: bytes(r.ids) for r in parts}
        assert len(parts) == copies * len(by_start)
        joined.add((doc, tuple(np.frombuffer(b"".join(by_start[s] for s in sorted(by_start)), "<u4").tolist())))
    assert joined == expected
    assert pack_documents(docs.limit(0), WORDS, 1).count() == 0


def test_token_files(spark):
    data, docs = rows(spark)
    path = shared_path(spark, "test-token-files")
    write_token_files(docs, path, BYTES, 2, segment_ids=100)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    by_id = {}
    for (d, t, _), ids in zip(data, reference(BYTES, [t for _, t, _ in data])):
        by_id[d] = [*ids, 2]
    assert [r.doc_id for r in got] == sorted([d for d, _, _ in data], key=lambda d: -1 if d is None else d)
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and ids == by_id[r.doc_id]
        at += len(ids)
    empty = shared_path(spark, "test-token-files")
    write_token_files(docs.limit(0), empty, BYTES, 2)
    assert read_token_files(spark, empty).count() == 0


def test_queries_on_small_table(spark):
    from marketframe.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    ids = dict(zip(sorted(docs), reference(BYTES, [docs[k] for k in sorted(docs)])))
    got, at = {r.doc_id: r for r in QUERIES["op2_token_files"](spark, d).collect()}, 0
    for k in sorted(docs):
        whole = np.array([*ids[k], 2], "<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(whole), zlib.crc32(whole.tobytes()))
        at += len(whole)
    packed = QUERIES["op1_packing"](spark, d).collect()
    ids = dict(zip(sorted(docs), reference(WORDS, [docs[k] for k in sorted(docs)])))
    assert sum(r.length for r in packed) == sum(len(v) + 1 for v in ids.values())
    for r in packed:
        piece = np.array([*ids[r.doc_id], 1], "<u4")[r.start: r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id]) + 1
