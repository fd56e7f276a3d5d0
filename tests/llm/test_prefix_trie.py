"""The trie against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marketframe.llm import prefix_trie as module
from marketframe.llm.prefix_trie import OP12_SQL, conversation_trie, op12_prefix_trie, rebuilt_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(m) - 1) * len(re.findall("[^ \t-\r]+", key[-1][1])) if key else 0
    out = []
    for key, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(key))))
        out.append((min(m), len(key), min(members[key[:-1]]) if key else None, len(m), children[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, trie=rebuilt_trie, **how):
    made = trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    assert [t for _, t in made.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted((tuple(r) for r in made.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def talks(n, seed):
    r, rows = random.Random(seed), []
    texts = ["hi", "hi there", "what  is\tthis", "", None, "yes", "no thanks"]
    for c in r.sample(range(-30, 20 * n), n):
        rows += [(c, r.choice([None, 0, 1, 2, 3, 4, 5]), r.choice(["user", "user", "bot", None]), r.choice(texts)) for _ in range(r.choice([1, 1, 2, 3, 5, 9]))]
    return rows


@pytest.mark.parametrize("container", [2, 256])
def test_against_brute_force(spark, container):
    rows = talks(90, 4)
    assert found(spark, rows, container=container) == brute(rows)
    assert found(spark, rows, conversation_trie, container=container) == brute(rows, rebuild=False)


@pytest.mark.parametrize("container", [2, 256])
def test_copies_prefixes_and_common_beginnings(spark, container, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 7)
    same = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(30)]                     # one long conversation, many times
    begins = [(c, t, "user", f"turn {t}" if t < 12 else f"own {c} {t}") for c in range(200, 230) for t in range(14 + c % 3)]
    shorter = [(c, t, "user", f"turn {t}") for c in range(300, 310) for t in range(c - 299)]
    rows = same + begins + shorter
    assert found(spark, rows, container=container) == brute(rows)
    assert found(spark, rows, conversation_trie, container=container) == brute(rows, rebuild=False)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "STRETCH", 16)
    rows = [(7, t, "user", "again and again") for t in range(700)] + [(c, t, "user", "again and again") for c in (1, 2, 20, 47) for t in range(c % 9)]
    assert found(spark, rows) == brute(rows)


def test_a_conversation_may_span_tasks(spark):
    rows = [(5, t, "u", f"t{t}") for t in range(300)] + [(6, 0, "u", "t0")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)).where("conv_id = 5").orderBy("depth").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.depth for r in made] == list(range(301)) and [r.n_convs for r in made[:2]] == [2, 2] and made[1].n_children == 1


def test_nulls_ties_and_empty_tables(spark):
    rows = [(1, None, None, None), (1, None, "", ""), (1, 0, "a", "b"), (1, 0, "a", "b"), (None, 1, "a", "b"), (20, 0, "x", None), (21, 0, "y", "one"), (39, 0, "z", "two"), (-3, 5, "q", "w e")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, 1, "a", "b")]) == [] == found(spark, [])
    odd = spark.createDataFrame([(1, 0, "a", "b", 5, "k")], "conv_id int, turn int, role string, text string, depth int, key string")
    assert [r.depth for r in conversation_trie(odd).orderBy("depth").collect()] == [0, 1]


def test_query_is_its_sql(spark, same_as_sql):
    rows = same_as_sql(op12_prefix_trie(spark, SF), OP12_SQL, tables=("conversations",))
    assert len(rows) > 50


def test_sql_takes_the_same_edge_cases(spark, same_as_sql):
    rows = talks(60, 9)
    given = spark.createDataFrame(rows, SCHEMA)
    same_as_sql(rebuilt_trie(given, container=2).where(F.col("depth") >= 0), OP12_SQL, tables=("conversations",), given={"conversations": given.toPandas().astype({"conv_id": "int64", "turn": "Int64"})})
