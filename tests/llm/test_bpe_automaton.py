"""The automaton against a brute-force merge loop and against the unmodified library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from marketframe.llm.bpe_automaton import Automaton, BpeCodec, codec, decode_documents, encode_documents, op11_bpe_automaton

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids(coded):
    return np.frombuffer(coded, "<u4").tolist()


def small_vocabulary(pairs):
    labels, merges = {b: bytes([b]) for b in range(256)}, []
    token = {v: k for k, v in labels.items()}
    for u, v in pairs:
        if u in token and v in token and u + v not in token:
            token[u + v] = len(labels)
            labels[token[u + v]] = u + v
            merges.append((token[u], token[v], token[u + v]))
    return labels, merges


def merged(piece, merges):
    """Every merge over the whole piece, in order of priority."""
    out = list(piece)
    for u, v, made in merges:
        i, after = 0, []
        while i < len(out):
            if out[i: i + 2] == [u, v]:
                after.append(made)
                i += 2
            else:
                after.append(out[i])
                i += 1
        out = after
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=4), st.text("ab", min_size=1, max_size=4)), max_size=12), st.text("ab", max_size=14))
def test_any_small_vocabulary(pairs, piece):
    labels, merges = small_vocabulary([(u.encode(), v.encode()) for u, v in pairs])
    automaton = Automaton(labels, merges, memo=4)
    assert len(automaton.parent) <= len(merges) + 1
    found = automaton.encode(piece.encode()) if piece else []
    assert found == merged(piece.encode(), merges)
    assert automaton.decode(found) == piece.encode()


def test_one_path_spells_a_text():
    labels, merges = small_vocabulary([(b"a", b"b"), (b"a", b"a"), (b"ab", b"a"), (b"b", b"b"), (b"aa", b"aa"), (b"aba", b"bb")])
    automaton = Automaton(labels, merges)

    def paths(state, rest):
        if not rest:
            return [[]]
        return [[t, *more] for t, label in labels.items() if rest.startswith(label) and (then := automaton.arc(state, t)) >= 0 for more in paths(then, rest[len(label):])]

    for n in range(1, 9):
        for k in range(1 << n):
            piece = bytes(b"ab"[k >> i & 1] for i in range(n))
            assert paths(0, piece) == [merged(piece, merges)] == [automaton.encode(piece)]


def test_pieces_are_the_library_s():
    split, c = pre_tokenizers.ByteLevel(add_prefix_space=False), codec(VOCABULARY)
    for k in range(0x530):
        text = f"a{chr(k)}1{chr(k)}\n {chr(k)}{chr(k)} b"
        assert c.pieces(text) == [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)], hex(k)


def test_ids_and_texts_are_the_library_s(library):
    c, r = codec(VOCABULARY), random.Random(3)
    parts = ["the", "ing", " ", "  ", "\n", "日本", "é", "'s", "'S", "12", "==", "<|endoftext|>", "<|endoftext", "՘", "\x85", " ", "😀", "\x00", "aaaa", "̀"]
    texts = ["".join(r.choice(parts) if r.random() < 0.6 else r.choice("abcdefghinorstuTHE .-=") for _ in range(r.randrange(30))) for _ in range(3000)]
    texts += ["a <|endoftext|> b <|startoftext|>", " <|endoftext|>  \n", "", "x" * 70_000, "ab" * 40_000, " " * 5000, "".join(r.choice("abcdefgh") for _ in range(50_000))]
    for text in texts:
        found = ids(c.encode(text))
        assert found == library.encode(text, add_special_tokens=False).ids
        assert c.decode(c.encode(text)) == library.decode(found, skip_special_tokens=False) == text
    for _ in range(500):
        some = [r.randrange(60_000) for _ in range(r.randrange(9))]
        assert c.decode(np.array(some, "<u4").tobytes()) == library.decode(some, skip_special_tokens=False)


def test_ids_do_not_depend_on_the_cache(library):
    c = BpeCodec(VOCABULARY, cache_pieces=2)
    for text in ("one two three four five one two", "six " * 50):
        assert ids(c.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="not a plain byte-level"):
        BpeCodec(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="every byte"):
        Automaton({0: b"a"}, [])


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op11_bpe_automaton(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = library.decode(want, skip_special_tokens=False)
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_odd_tables(spark):
    schema = "ids string, text string, row int, made int, n_tokens string"
    odd = spark.createDataFrame([("x", None, 1, 2, "y"), (None, "", None, None, None), ("x", "ab cd", 1, 2, "y"), ("x", "ab cd", 1, 2, "y"), ("z", "long " * 30_000, 3, 4, "q")], schema)
    made = decode_documents(encode_documents(odd, VOCABULARY), VOCABULARY)
    assert made.columns == ["text", "row", "made", "n_tokens", "ids", "decoded"]
    rows = made.collect()
    assert sorted(r.decoded for r in rows) == sorted((r.text or "") for r in rows)
    assert [(r.n_tokens, bytes(r.ids)) for r in rows if not r.text] == [(0, b"")] * 2
    assert encode_documents(odd.limit(0), VOCABULARY).count() == 0 == decode_documents(made.limit(0), VOCABULARY).count()
