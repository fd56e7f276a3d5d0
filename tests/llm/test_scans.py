"""Licence scan and decontamination against SQL and brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from marketframe.llm.decontaminate import OP8_SQL, benchmark_hits, decontaminated, op8_decontamination
from marketframe.llm.fm_index import FMIndex, suffix_array
from marketframe.llm.licenses import OP7_SQL, TEMPLATES, op7_licenses, scan_licenses
from marketframe.llm.textscan import scan_words, shingle_hashes, word_hashes

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_and_hashes():
    texts = ["", None, "Ab c_d É9", "x", "ab", "--", "ÀB ab"]
    from marketframe.llm.arrow import text_buffer
    data, offsets = text_buffer(pa.array(texts))
    folded, s, e, first = scan_words(data, offsets)
    got = [[folded[a:b].tobytes().decode() for a, b in zip(s[first[i]:first[i + 1]], e[first[i]:first[i + 1]])] for i in range(len(texts))]
    assert got == [words(t) for t in texts]
    h = dict(zip(word_hashes(folded, s, e).tolist(), [w for g in got for w in g]))
    assert len(h) == len({w for g in got for w in g})
    sh, at = shingle_hashes(word_hashes(folded, s, e), first, 2)
    assert np.diff(at).tolist() == [max(len(g) - 1, min(1, len(g))) for g in got]


def test_fm_index_finds_all_places():
    rng = random.Random(5)
    for _ in range(40):
        text = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 200))] + [0])
        order = suffix_array(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        index = FMIndex(text, sample=rng.choice([1, 3, 8]))
        for n in (1, 2, 4):
            patterns = np.array([[rng.randint(1, 4) for _ in range(n)] for _ in range(6)])
            low, high = index.count(patterns)
            for p, a, b in zip(patterns, low, high):
                assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(text)) if text[i: i + n].tolist() == p.tolist()]


def brute(docs, items, size=10):
    out = []
    for name, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            k = min(size, len(iw))
            wins = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    found.add(str(item))
        out.append((name, len(w), sorted(hit), sorted(found)))
    return out


@pytest.mark.parametrize("blocks", [1 << 20, 60])
def test_benchmark_hits_equal_brute_force(spark, blocks):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "c", "É"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 10, 12, 30])))) for i in range(4, 14)] + [(1, None), (2, ""), (3, "--")]
    items = [x for x in items if len(words(x[1])) != 1] + [(99, "zz")]
    docs = [(i, ", ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(30)] + [(100, None), (101, ""), (5, items[3][1]), (5, items[3][1]), (None, "Zz zz"), (200, "a b " * 3000)]
    d = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, spans long").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc.doc_id, r.n_words, [x for s in r.spans for x in range(s["from"], s["to"])], list(r["items"])) for r in benchmark_hits(d, b, block_bytes=blocks, shard_bytes=200).collect()]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)
    assert benchmark_hits(d.limit(0), b).count() == 0
    assert all(not r.spans for r in benchmark_hits(d, b.limit(0)).collect())


def test_decontaminated_cuts_passages_and_keeps_the_rest(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    d = spark.createDataFrame([(1, f"Before. {passage.title()}! After.", "x"), (2, "clean text", "y"), (3, None, None)], "doc_id long, text string, doc string")
    b = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = {r.doc_id: (r.text, r.doc) for r in decontaminated(d, b).collect()}
    assert got == {1: ("Before. ! After.", "x"), 2: ("clean text", "y"), 3: (None, None)}
    assert decontaminated(d, b).schema == d.schema


def test_op8_equals_sql(spark, same_as_sql):
    rows = same_as_sql(op8_decontamination(spark, SMALL), OP8_SQL)
    assert any(r[0] for r in rows)


def test_op7_equals_sql(spark, same_as_sql, tmp_path):
    rows = same_as_sql(op7_licenses(spark, SMALL), OP7_SQL)
    assert any(r[4] for r in rows)
    texts = ["", None, "GNU General Public License, gnu general public license; mit license cc-by", "CC BY cc by cc by", "mit  license" * 3, "CC BY".replace("C", "K")]
    texts += [body for _, _, body in TEMPLATES] + [body.upper().replace(" ", "\n") + " tail" for _, _, body in TEMPLATES]
    texts += [" ".join("x" if i % 7 == 6 else w for i, w in enumerate(body.split())) for _, _, body in TEMPLATES]
    texts += [key + " cut" for _, key, _ in TEMPLATES] + ["lead " + body[: len(body) // 2] for _, _, body in TEMPLATES] + ["mit license " * 4000]
    import pandas as pd
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)})
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(op7_licenses(spark, str(tmp_path)), OP7_SQL, ("documents",), {"documents": frame})


def test_license_scan_edges(spark):
    d = spark.createDataFrame([(1, "mit license", "z"), (1, "mit license", "z"), (None, None, None)], "doc_id long, text string, license_scan string")
    got = scan_licenses(d)
    assert got.columns == ["doc_id", "text", "license_scan"]
    assert sorted((r.license_scan.n_words, r.license_scan.score) for r in got.collect()) == [(0, 0.0), (2, 1.0), (2, 1.0)]
    assert scan_licenses(d.limit(0)).count() == 0


def test_benchmark_rows_without_an_id_hit_as_in_sql(spark, same_as_sql, tmp_path):
    import pandas as pd
    long = " ".join(f"w{i}" for i in range(14))
    docs = [(1, "a " + long + " z"), (2, "short one"), (3, "nothing here"), (4, "short one " + long)]
    items = [(None, long), (7, "short one"), (None, "short one"), (8, None)]
    given = {"documents": pd.DataFrame(docs, columns=["doc_id", "text"]), "benchmark": pd.DataFrame({"item_id": pd.array([i for i, _ in items], "Int64"), "text": [t for _, t in items]})}
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    same_as_sql(op8_decontamination(spark, str(tmp_path)), OP8_SQL, given=given)
    clean = {r.doc_id: r.text for r in decontaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert clean[1] == "a  z" and clean[3] == "nothing here" and "w3" not in clean[4]
