"""Phrase counts and ranks against brute force and SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketframe.llm.arrow import Scratch
from marketframe.llm.collocations import OP13_SQL, Filter, collocations, op13_collocations
from marketframe.llm.hat_trie import HatTrie, grouped

SF = "/root/testdata/sf0.001"


def brute(rows, least, top, covered=80):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i: i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = any(100 * b >= covered * a and len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **how):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(tuple(r) for r in collocations(docs, **how).collect())


def texts(n, seed):
    r = random.Random(seed)
    words = ["The", "the", "of", "a", "new", "york", "été", "city", "x\x00y", "日本", "Ünder"]
    glue = [" "] * 12 + ["\t", "  ", ", ", ".", "\n", "! ", "\r\n", "-", "\x0b"]
    return [("".join(r.choice(words) + r.choice(glue) for _ in range(r.randrange(60))), r.choice(["en", "en", "en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("how", [{}, {"budget": 50, "burst": 8}, {"most_filter_bits": 1}])
def test_against_brute_force(spark, how):
    rows = texts(120, 1)
    assert found(spark, rows, least=3, top=40, **how) == brute(rows, 3, 40)


def test_ties_hot_words_and_long_texts(spark):
    rows = [("a a a a a a", "en")] * 50 + [("hot word " * 20_000, "en"), ("x y. x y. p q! p q", "de"), ("", None), (None, None), (None, "fr")]
    got = found(spark, rows, least=2, top=3)
    assert got == brute(rows, 2, 3)
    assert [r[2] for r in got if r[0] == "de"] == ["p q", "x y"]


def test_frequent_phrases_are_not_sent_by_every_task(spark, monkeypatch):
    stored, store = {}, Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, df, name: stored.setdefault(name, store(self, df, name)))
    rows = [(f"alpha beta gamma, item number {i}", "en") for i in range(640)]
    got = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(40), least=30).collect()
    assert sorted(map(tuple, got)) == brute(rows, 30, 2000)
    short = stored["runs"].where("w1 != 0 and w4 = 0 and n >= 0").count()
    assert 9 <= short < 40 * 9 / 2                          # five words, three pairs and a triple: 40 tasks hold each


def test_triples_of_infrequent_pairs_are_not_dealt(spark, monkeypatch):
    rows = [(f"alpha beta gamma, item number {i} beta gamma delta. alpha {i} gamma", "en") for i in range(400)] + [("alpha beta gamma", "de")] * 20
    docs, dealt = spark.createDataFrame(rows, "text string, lang string").repartition(1), []
    repartition = type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda self, *by: dealt.append(self) or repartition(self, *by))
    assert sorted(map(tuple, collocations(docs, least=30).collect())) == brute(rows, 30, 2000)
    f = Counter((lang, *words[i: i + m]) for text, lang in rows for piece in re.split("[.,]", text) for words in [piece.split()]
                for m in (1, 2, 3) for i in range(len(words) - m + 1))
    short = sum(len(p) <= 3 for p in f)                     # words and pairs
    triples = [p for p in f if len(p) == 4]
    kept = sum(f[p[:3]] >= 30 and f[p[0], *p[2:]] >= 30 for p in triples)
    rows_dealt = [d.count() for d in dealt]
    assert rows_dealt[0] == short and kept == 2 and len(triples) > 1600
    assert kept <= sum(rows_dealt[1:]) < len(triples) / 4   # the filter may let some more through


def test_copies_marks_and_counts_beyond_one_slice(spark):
    rows = [("one and the same. text of a copy", "en")] * 90 + [("the same text", lang) for lang in ("en", "de", None)] * 40 + [("of a copy " * 3, None)] * 20
    for budget in (1 << 20, 4):
        assert found(spark, rows, least=30, budget=budget, burst=2) == brute(rows, 30, 2000)


def test_empty_and_odd_tables(spark):
    odd = spark.createDataFrame([("a b", "en", 1, 2, "z")] * 3, "text string, lang string, w1 int, n int, word string")
    assert [r.phrase for r in collocations(odd, least=3).collect()] == ["a b"]
    assert collocations(odd.limit(0), least=3).collect() == []
    assert collocations(odd, least=4).collect() == []


def test_query_is_its_sql(spark, same_as_sql):
    assert len(same_as_sql(op13_collocations(spark, SF), OP13_SQL)) >= 30


def test_trie_counts_whatever_its_bounds():
    r = np.random.default_rng(5)
    for budget, burst in ((10, 2), (200, 16), (1 << 20, 1 << 15)):
        trie, total, got = HatTrie(3, budget, burst), Counter(), Counter()
        runs = []
        for _ in range(30):
            rows = r.integers(0, 5, (40, 3)).astype(np.uint64)
            rows[:13, 0] = 1                                # a hot first number
            total.update(map(tuple, rows.tolist()))
            runs += trie.add(list(rows.T), np.ones(40, np.int64))
            assert trie.rows <= budget
        runs += trie.spill()
        assert trie.rows == 0
        for places, n in runs:
            keys = list(zip(*[p.tolist() for p in places]))
            assert keys == sorted(set(keys))
            for k, c in zip(keys, n.tolist()):
                got[k] += c
        assert got == total


def test_trie_keeps_the_greatest_note():
    from marketframe.llm.collocations import _NOTE, _NOTE_BITS, _noted
    r = np.random.default_rng(7)
    keys, notes = r.integers(0, 50, 4000).astype(np.uint64), r.integers(0, _NOTE + 1, 4000)
    trie, got = HatTrie(1, 20, 4, _noted), {}
    runs = [run for i in range(0, 4000, 100) for run in trie.add([keys[i: i + 100]], 1 << _NOTE_BITS | notes[i: i + 100])]
    for (run,), packed in runs + list(trie.spill()):
        for k, n, note in zip(run.tolist(), (packed >> _NOTE_BITS).tolist(), (packed & _NOTE).tolist()):
            before = got.get(k, (0, 0))
            got[k] = before[0] + n, max(before[1], note)
    assert got == {k: ((keys == k).sum(), notes[keys == k].max()) for k in np.unique(keys).tolist()}


def test_rows_of_one_hash_stay_apart(monkeypatch):
    from marketframe.llm import hat_trie
    monkeypatch.setattr(hat_trie, "mixed", lambda h: h * np.uint64(0))
    places, n = grouped([np.array([1, 2, 1, 2], np.uint64), np.array([1, 1, 1, 1], np.uint64)], np.ones(4, np.int64))
    assert sorted(zip(*[p.tolist() for p in places], n.tolist())) == [(1, 1, 2), (2, 1, 2)]


def test_filter_holds_all_it_was_given(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 64, 3000, dtype=np.uint64)
    given = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "gram long")
    for bits in (1, 1 << 20):
        f = Filter.of(given, bits)
        assert f.passes(keys).all()
    assert f.passes(np.random.default_rng(2).integers(0, 1 << 64, 3000, dtype=np.uint64)).mean() < 0.05
