"""Token counts against the tokenizers library's WordPiece; language model against a plain one."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import models

from marketframe.llm.language import identify, ngram_buckets, op3_language, train
from marketframe.llm.textscan import NOT_SPACE
from marketframe.llm.token_counts import Automaton, byte_level_pieces, count_tokens, op9_token_counts
from marketframe.llm.token_ids import BYTE_LETTERS

SMALL = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def split(text):
    out, word = [], b""
    for b in (text or "").encode():
        if NOT_SPACE[b]:
            word += bytes([b])
        elif word:
            out.append(word)
            word = b""
    return [*out, word] if word else out


def shown(piece):
    return "".join(BYTE_LETTERS[b] for b in piece)


def word_piece(initial, continuing):
    vocabulary = {shown(p): i for i, p in enumerate(initial)} | {"##" + shown(p): len(initial) + i for i, p in enumerate(continuing)}
    vocabulary["[none]"] = len(vocabulary)
    return models.WordPiece(vocabulary, unk_token="[none]", max_input_chars_per_word=1 << 30)


def test_lengths_equal_word_piece_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(60):
        some = lambda n: sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(n)})
        initial, continuing = some(rng.randint(1, 12)), some(rng.randint(1, 12))
        model, automaton = word_piece(initial, continuing), Automaton.of(initial, continuing)
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.choice([1, 3, 8, 30, 90]))) for _ in range(40)]
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        got = automaton.lengths(data, ends - [len(w) for w in words], ends)
        for w, n in zip(words, got.tolist()):
            tokens = [t.value for t in model.tokenize(shown(w))]
            assert n == (0 if tokens == ["[none]"] else len(tokens)), (w, initial, continuing)


def test_op9_equals_word_piece(spark):
    initial, continuing = byte_level_pieces(BYTES)
    model = word_piece(initial, continuing)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op9_token_counts(spark, SMALL).collect()}
    assert len(got) == len(texts)
    for k, t in texts:
        words = split(t)
        assert (got[k].n_words, got[k].n_tokens, got[k].n_unknown) == (len(words), sum(len(model.tokenize(shown(b" " + w))) for w in words), 0)


def test_count_edges(spark):
    automaton = Automaton.of(*byte_level_pieces(BYTES), lead=b" ")
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (1, "the the", None), (None, "z" * 100_000, "x")], "doc_id long, text string, n_words string")
    got = count_tokens(docs, automaton).collect()
    assert [(r.doc_id, r.n_words) for r in got] == [(1, 0), (1, 0), (1, 2), (None, 1)]
    assert got[2].n_tokens == 2 and got[0].n_tokens == 0 and got[3].n_tokens > 1000
    assert count_tokens(docs.limit(0), automaton).count() == 0
    assert count_tokens(docs, Automaton.of([], [])).collect()[2].n_unknown == 2


def plain_ngrams(text):
    return [b for bucket, _ in ngram_buckets([text]) for b in bucket.tolist()]


def test_ngrams_do_not_cross_texts():
    texts = ["ab", "", None, "Çd e", "x"]
    by_order = list(ngram_buckets(texts))
    assert [c.tolist() for _, c in by_order] == [[2, 0, 0, 4, 1], [1, 0, 0, 3, 0], [0, 0, 0, 2, 0]]
    whole = Counter(b for bucket, _ in by_order for b in bucket.tolist())
    assert whole == Counter(b for t in texts for b in plain_ngrams(t))


def test_identify_equals_plain_naive_bayes(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"), ("the end", "en"), (None, "en"), ("no language", None)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    model = train(docs)
    assert model.languages == ["de", "en", "fr"]
    counts, seen = {}, Counter(x for _, x in rows if x)
    for t, x in rows:
        if x:
            counts.setdefault(x, Counter()).update(plain_ngrams(t or ""))
    ask = ["und die", "the", "chien", "", None, "123 --", "²", "Ω"]
    got = identify(spark.createDataFrame([(t, "clash") for t in ask], "text string, lang_pred string"), model).collect()
    for t, r in zip(ask, got):
        if not t or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.lang_score) == ("und", 0.0)
            continue
        log = {}
        for x, c in counts.items():
            total = sum(c.values()) + 0.5 * (1 << 15)
            log[x] = math.log(seen[x] / 5) + sum(math.log((c[b] + 0.5) / total) for b in plain_ngrams(t))
        best = max(log, key=log.get)
        assert r.lang_pred == best
        assert abs(r.lang_score - 1 / sum(math.exp(v - log[best]) for v in log.values())) < 1e-4
    nothing = train(docs.limit(0))
    assert identify(docs, nothing).where("lang_pred != 'und' or lang_score != 0").count() == 0
    assert identify(docs.limit(0), model).count() == 0


def test_op3_on_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op3_language(spark, SMALL).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
