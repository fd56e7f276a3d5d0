"""Every stage of the pipeline on its own input, against plain references."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from marketframe.llm import language, quality
from marketframe.llm.arrow import Scratch
from marketframe.llm.near_duplicates import deduplicated, near_duplicates

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def stages(spark):
    scratch, out = Scratch(spark, "test-pipeline"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = scratch.store(stage(spark, docs, SF), name)
        out.append((docs, made))
        docs = made
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "packing"]
    for docs, made in stages[:-1]:
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        assert 0 < made.count() <= docs.count()


def test_quality_stage(spark, stages):
    docs, made = stages[0]
    scored = quality.score_quality(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert set(rows(made)) == {r.doc_id for r in scored if r.quality_score >= 0.7}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in rows(made) for d in good) >= 0.95 * len(good)
    assert all(r == rows(docs)[d] for d, r in rows(made).items())


def test_language_stage(stages):
    docs, made = stages[1]
    found = language.identify(docs, language.train(docs)).collect()
    assert set(rows(made)) == {r.doc_id for r in found if r.lang_pred != "und" and r.lang_score >= 0.5}
    assert all(r == rows(docs)[d] for d, r in rows(made).items())


def test_near_duplicates_stage(stages):
    docs, made = stages[2]
    assert set(rows(made)) == {r.class_id for r in near_duplicates(docs).collect()}
    assert all(r == rows(docs)[d] for d, r in rows(made).items())


def test_decontamination_stage(spark, stages):
    docs, made = stages[3]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + min(10, len(w))]) for i in range(max(len(w) - 9, min(1, len(w))))}
    after, sizes, cut = rows(made), {len(w) for w in windows}, 0
    for d, r in rows(docs).items():
        w, hit = words(r.text), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
        assert words(after[d].text) == [x for i, x in enumerate(w) if i not in hit]
        assert after[d].n_chars == len(after[d].text) and (hit or after[d].text == r.text)
        cut += bool(hit)
    assert cut and set(after) == set(rows(docs))


def test_packing_stage(stages):
    docs, made = stages[4]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in made.collect():
        pieces.setdefault(r.doc_id, {})[r.start] = r.ids
    for d, r in rows(docs).items():
        joined = np.frombuffer(b"".join(bytes(pieces[d][s]) for s in sorted(pieces[d])), "<u4").tolist()
        assert joined == [*t.encode(r.text, add_special_tokens=False).ids, 1]


def test_run_and_entry(spark, stages):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() == stages[-1][1].count()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()


ODD = ["quality_score", "lang_pred", "lang_score", "row", "made", "copy", "id", "tie", "_copy", "_known", "_kept_id", "key", "node", "_0", "c0", "words"]


def test_stages_take_empty_and_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in ODD)
    own = [f"own {c}" for c in ODD]
    odd = spark.createDataFrame([(1, None, None, None, None, *own), (2, "", "en", "s", 0, *own), (2, "", "en", "s", 0, *own), (None, "no id at all here", "en", "s", 17, *own),
                                 (3, "word " * 5000, "en", "s", 25000, *own)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            found = made.collect()
            assert len(found) <= max(docs.count(), 20)
            if name != "packing":
                assert made.dtypes == docs.dtypes
                assert all([r[c] for c in ODD] == own for r in found)


def test_of_rows_with_one_id_the_same_stays(spark):
    rows = [(1, "one text", "a"), (1, "another text", "b"), (1, "one text", "c"), (None, "no id", "d"), (None, "no id", "e")]
    kept = [sorted(map(tuple, deduplicated(spark.createDataFrame(part, "doc_id long, text string, tie string").repartition(n)).collect()), key=str)
            for part, n in ((rows, 1), (rows[::-1], 4))]
    assert kept[0] == kept[1] and len(kept[0]) == 2
