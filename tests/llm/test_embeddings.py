"""Near vectors against brute force."""

import numpy as np

from marketframe.llm.embeddings import _forest, learn_rotation, near_vectors, op4_near_vectors, substrings, table_plan, unit

SF = "/root/testdata/sf0.1"


def brute(rows, cosine=0.95):
    fine = [i for i, (_, e) in enumerate(rows) if e and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    linked = np.zeros((len(rows),) * 2, bool)
    for size in {len(rows[i][1]) for i in fine}:
        mine = [i for i in fine if len(rows[i][1]) == size]
        x = unit(np.array([rows[i][1] for i in mine]))
        linked[np.ix_(mine, mine)] = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    return linked


def classes(linked, ids):
    root = _forest(linked)
    return [min(ids[j] for j in np.flatnonzero(root == r)) for r in root]


def test_forest():
    linked = np.zeros((7, 7), bool)
    for a, b in ((0, 6), (6, 3), (3, 5), (1, 2)):
        linked[a, b] = linked[b, a] = True
    assert _forest(linked).tolist() == [0, 1, 1, 0, 4, 0, 0]


def test_rotation_is_orthogonal_and_lowers_the_quantisation_error():
    x = unit(np.random.default_rng(1).normal(size=(500, 16)) * np.linspace(1, 4, 16))
    error = lambda r: ((np.where(x @ r >= 0, 1, -1) / 4 - x @ r) ** 2).sum()
    r = learn_rotation(x, 3)
    assert np.allclose(r @ r.T, np.eye(16)) and error(r) < error(learn_rotation(x, 3, 0))
    bits, tables = table_plan(50_000, 0.95)
    assert bits == 16 and substrings(x, [r] * 30, bits, tables).shape == (500, tables)


def test_recall_against_brute_force(spark, tmp_path):
    """The given vectors, and for each a neighbour at a cosine of about 0.94 to 1."""
    rng = np.random.default_rng(3)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    x = unit(np.array([e for _, e in rows]))
    noise = unit(rng.normal(size=x.shape)) * rng.uniform(0, 0.36, (len(x), 1))
    rows += [(10_000 + i, v) for i, v in enumerate((x + noise).astype(np.float32).astype(float).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.vec_id: r for r in op4_near_vectors(spark, str(tmp_path)).collect()}
    linked = brute(rows)
    true, found = linked.sum(), sum(r.n_links for r in got.values())
    assert len(got) == len(rows) and true > 2000 and 0.99 * true <= found <= true
    for (i, _), n in zip(rows, linked.sum(1).tolist()):
        assert got[i].n_links <= n
    ids = [i for i, _ in rows]
    expected = dict(zip(ids, classes(linked, ids)))
    assert sum(got[i].component_id == expected[i] for i in ids) >= 0.99 * len(ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_edges(spark, monkeypatch):
    from marketframe.llm import embeddings
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(i, (base + 0.01 * rng.normal(size=8)).tolist()) for i in range(60)]
    rows += [(100 + i, base.tolist()) for i in range(40)] + [(200 + i, rng.normal(size=8).tolist()) for i in range(30)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8), (305, [float("inf")] * 8),
             (306, [1e-30] * 8), (307, [1e30] * 8), (308, [1.0] * 4), (309, [2.0] * 4), (310, (-base).tolist())]
    frame = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, kept string").repartition(3)
    got = {r.vec_id: r for r in near_vectors(frame).collect()}
    linked, ids = brute(rows), [i for i, _ in rows]
    for (i, _), n, c in zip(rows, linked.sum(1).tolist(), classes(linked, ids)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, i == c), i
    twice = spark.createDataFrame([(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 2.0]), (None, [-1.0, 0.5])], "vec_id long, embedding array<float>")
    assert sorted((str(r.vec_id), r.n_links) for r in near_vectors(twice).collect()) == [("7", 2), ("7", 2), ("None", 0), ("None", 2)]
    assert near_vectors(frame.limit(0)).count() == 0
