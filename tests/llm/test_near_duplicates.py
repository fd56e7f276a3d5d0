"""Near-duplicates: samples against their expectation, classes against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from marketframe.llm.arrow import Scratch, text_buffer
from marketframe.llm.graph import components
from marketframe.llm.near_duplicates import (BANDS, DF_BUCKETS, ROWS, Sampler, Shingles, Weights, _left_over, band_keys, deduplicated, near_duplicates,
                                             op10_near_duplicates, weighted_jaccard)

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FLAT = Weights(np.zeros(DF_BUCKETS, np.float32))


def shingles(texts):
    return Shingles.of(*text_buffer(pa.array(texts, pa.string())))


def plain_weights(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(1, len(w)))))
    return {g: 1 + math.log(n) for g, n in grams.items()}


def plain_jaccard(a, b):
    a, b = plain_weights(a), plain_weights(b)
    low = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = ["w%d" % i for i in range(500)]


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = "e%d" % rng.randrange(10 ** 6)
    return " ".join(w)


def test_weighted_jaccard_equals_plain():
    rng = random.Random(1)
    a = [words(rng, n) for n in (0, 1, 4, 5, 30, 300)] + ["x y z x y z x y z x y z", "same text here"]
    b = [edited(rng, t, 2) if t else t for t in a[:-2]] + ["x y z x y z", "same text here"]
    sa, sb = shingles(a), shingles(b)
    got = weighted_jaccard(sa, FLAT(sa), sb, FLAT(sb))
    for x, y, g in zip(a, b, got):
        assert abs(g - plain_jaccard(x, y)) < 1e-9


def test_samples_agree_as_often_as_weights_do():
    rng = random.Random(4)
    base = [words(rng, 200) for _ in range(60)]
    other = [edited(rng, t, 4) for t in base]
    sa, sb = shingles(base), shingles(other)
    draw = Sampler()
    a, b = draw(sa, FLAT(sa)), draw(sb, FLAT(sb))
    expected = weighted_jaccard(sa, FLAT(sa), sb, FLAT(sb)).mean()
    assert abs((a == b).mean() - expected) < 0.02
    assert (band_keys(a) == band_keys(a.copy())).all() and a.shape == (60, BANDS * ROWS)


def test_common_shingles_weigh_less():
    s = shingles(["a b c d e", "f g h i j"])
    counts = np.zeros(DF_BUCKETS)
    counts[(s.hashes[0] >> np.uint64(50 - 18)).astype(int)] = 900
    w = Weights.of(counts, 1000)(s)
    assert 1 <= w[0] < w[1] <= 1.2 + 1e-6


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (200, 300), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def brute_classes(docs, similarity=0.8):
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] or "") == (docs[j][1] or "") or (docs[i][0] is not None and docs[i][0] == docs[j][0]) or (
                    docs[i][0] is not None and docs[j][0] is not None and plain_jaccard(docs[i][1], docs[j][1]) >= similarity):
                root[find(i)] = find(j)
    out = []
    for i in range(len(docs)):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((docs[i][0], min(ids, default=None)))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(8)
    docs, n = [], 0
    for _ in range(12):
        base = words(rng, rng.choice([60, 150, 400]))
        for k in range(rng.choice([1, 2, 6])):
            docs.append((n, base if k == 1 else edited(rng, base, k if k < 3 else 1)))
            n += 1
    passage = words(rng, 80)
    docs += [(n + i, words(rng, 60) + " " + passage) for i in range(30)]
    n += 30
    docs += [(n, None), (n + 1, ""), (n + 2, "--"), (n + 3, "two words"), (n + 4, "two words"), (n + 5, "long " * 30_000), (3, docs[3][1]), (4, words(rng, 50)), (None, docs[0][1]), (None, words(rng, 40))]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, class_id string").repartition(4)
    key = lambda r: (str(r[0]), str(r[1]))
    got = near_duplicates(frame).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=key) == sorted(brute_classes(docs), key=key)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    kept = deduplicated(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, {c for _, c in brute_classes(docs)}))
    assert near_duplicates(frame.limit(0)).count() == 0 and deduplicated(frame.limit(0)).count() == 0


def test_left_over_links_of_a_band(spark):
    """Whatever is already joined, all links between different components of a band are found."""
    rng = random.Random(6)
    base = words(rng, 120)
    texts = [edited(rng, base, rng.choice([1, 3, 6])) for _ in range(60)] + [words(rng, 120) for _ in range(10)]
    s = shingles(texts)
    samples = Sampler()(s, FLAT(s))
    keys = band_keys(samples)
    sketch = (samples & np.uint64(255)).astype(np.uint8)
    rows = [(int(k), n, n if n % 3 else 0, bytearray(sketch[n].tobytes()), keys[n].tolist(), t) for n, t in enumerate(texts) for k in keys[n]]
    members = spark.createDataFrame(rows, "key long, node long, root long, sketch binary, bands array<long>, text string")
    got = [(r.a, r.b) for r in _left_over(members, spark.sparkContext.broadcast(FLAT), 0.8).collect()]
    plain = {(i, j) for i in range(70) for j in range(i + 1, 70) if plain_jaccard(texts[i], texts[j]) >= 0.8 and set(keys[i]) & set(keys[j])}
    assert set(got) <= plain
    start = [(n, 0) for n in range(70) if n % 3 == 0]
    assert joined(start + got) == joined(start + list(plain))


def joined(links):
    root = list(range(70))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(70)]


def test_op10_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in op10_near_duplicates(spark, SMALL).collect()}
    sure, likely = dict(brute_classes(docs, 0.86)), dict(brute_classes(docs, 0.75))
    assert len(got) == len(docs)
    for d, c in got.items():                     # the weights move a similarity by a few hundredths
        assert got[sure[d]] == c and likely[c] == likely[d]


def test_an_id_of_several_texts_keeps_their_bands_apart(spark):
    """Each text of a repeated id is compared by its own bands: the classes are those of the texts under ids of their own."""
    rng = random.Random(12)
    bases = [words(rng, 120) for _ in range(6)]
    near = [edited(rng, bases[i % 6], 2 + i % 4) for i in range(90)]
    other = [words(rng, 40) for _ in near]
    apart = [(i, t) for i, t in enumerate(near)] + [(1000 + i, t) for i, t in enumerate(other)]
    under_one = [(d % 1000, t) for d, t in apart]
    expected = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(apart, "doc_id long, text string")).collect()}
    assert all(expected[1000 + i] == 1000 + i for i in range(len(near))) and len({expected[i] for i in range(len(near))}) > 6
    got = near_duplicates(spark.createDataFrame(under_one, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == sorted((i, expected[i]) for i in [*range(len(near))] * 2)


def test_a_left_over_pair_of_few_agreeing_samples_is_verified():
    """Half of the samples agree, less than four deviations below 0.8, but the texts link."""
    from marketframe.llm.near_duplicates import _block_links
    text, sketch = words(random.Random(5), 60), bytes(BANDS * ROWS)
    other = bytes(29) + bytes([1]) * 27                        # 29 of 56 agree: 0.518
    bands = [[1] + [10 * side + k for k in range(1, BANDS)] for side in (1, 2)]
    row = lambda node, s, b, t: (node, node, s, b, t)
    assert _block_links(1, [row(4, sketch, bands[0], text)], [row(7, other, bands[1], text + " end")], FLAT, 0.8) == [(4, 7)]
    assert _block_links(1, [row(4, sketch, bands[0], text)], [row(7, other, bands[1], words(random.Random(6), 60))], FLAT, 0.8) == []
