"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index Hamming tables, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch, read_table
from marketframe.llm.graph import components

COSINE = 0.95
#: Vectors the rotations are learnt from, at most.
SAMPLE = 4096
#: Share of the pairs at the threshold itself that may miss all tables; nearer pairs miss far fewer.
MISS = 0.01
BLOCK = 1024


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares neither over- nor underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """Iterative quantisation: from a random rotation, take the signs of the rotated rows as their codes, then
    the rotation that brings the rows nearest to these codes, again and again.  The rows aren't centred:
    it is their angles at the origin that codes must keep."""
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1],) * 2))[0]
    for _ in range(rounds if len(x) else 0):
        codes = np.where(x @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ codes)
        rotation = u @ v
    return rotation


def table_plan(vectors: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """Bits of a substring and number of tables: as many bits as tell the vectors apart, and so many tables
    that a pair at the threshold, whose codes differ in angle / pi of the bits, shares one but for ``miss``."""
    bits = min(24, max(8, round(math.log2(max(vectors, 2)))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - same))


def substrings(x: np.ndarray, rotations: list[np.ndarray], bits: int, tables: int) -> np.ndarray:
    """The codes of unit rows cut into substrings, one for each table."""
    code = np.concatenate([x @ r >= 0 for r in rotations], axis=1)[:, : bits * tables].reshape(len(x), tables, bits)
    return (code @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int32)


def _coded(nodes: DataFrame, sent, kind: str) -> DataFrame:
    """node, times, vec (unit, doubles), codes and the keys of its tables."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations, bits, tables = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(np.array(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), kind).reshape(batch.num_rows, -1))
            codes = substrings(x, rotations, bits, tables)
            keys = (np.arange(tables, dtype=np.int64) << 32) + codes
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), batch.column("times"), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * tables, pa.int32()), pa.array(keys.ravel()))], names=["node", "times", "vec", "codes", "keys"])

    return nodes.mapInArrow(code, "node long, times long, vec binary, codes binary, keys array<long>")


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row of its component."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root, len(linked)).min(1, initial=len(linked))
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _linked(members: DataFrame, cosine: float) -> DataFrame:
    """Links found in blocks of table buckets, as rows (a, b, links): with b null, ``links`` other vectors of
    node a; with links null, an edge of a forest that joins what the block links.

    ``members``: key, i, j, node, times, vec, codes; a block (key, i, j) compares block i
    of a bucket with block j.  A pair counts in the first table where it meets, so once.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def found() -> pa.RecordBatch:
            empty = pa.array([], pa.int64())
            if len(held) < 2:
                return pa.RecordBatch.from_arrays([empty] * 3, names=["a", "b", "links"])
            table, same_block = key[0] >> 32, key[1] == key[2]
            node, times, side = (np.array([r[c] for r in held], np.int64) for c in (0, 1, 4))
            x = np.frombuffer(b"".join(r[2] for r in held), np.float64).reshape(len(held), -1)
            codes = np.frombuffer(b"".join(r[3] for r in held), np.int32).reshape(len(held), -1)
            linked = x @ x.T >= cosine
            np.fill_diagonal(linked, False)
            linked &= node[:, None] != node
            if not same_block:                   # pairs inside a block have a block of their own
                linked &= side[:, None] != side
            for t in range(table):
                if not linked.any():
                    break
                linked &= codes[:, t][:, None] != codes[:, t]
            links = linked @ times
            some = np.flatnonzero(links)
            root = _forest(linked)
            joined = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([node[some], node[joined]])), pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[root[joined]])]),
                pa.concat_arrays([pa.array(links[some]), pa.nulls(len(joined), pa.int64())])], names=["a", "b", "links"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "times", "vec", "codes", "block")]
            for k, i, j, *row in zip(*columns):
                if (k, i, j) != key:
                    yield found()
                    held, key = [], (k, i, j)
                held.append(tuple(row))
        yield found()

    dealt = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(compare, "a long, b long, links long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable) and kept
    (vec_id = component_id), one row per row of ``vectors`` (vec_id, embedding).

    Two vectors link if their cosine, in double precision, is at least ``cosine``; vectors of
    different lengths never do.  Null and zero vectors, and vectors with null or non-finite
    components, link with nothing.  Repeated rows are vectors of their own that link with each other; a
    vec_id that stands for several vectors is one node.  A null vec_id links like any other if an equal
    vector has an id, else with nothing.  Other columns are not read; an empty table gives no rows.

    Equal vectors meet by hash and go on once, with their number.  Buckets of the tables are
    compared in blocks of about 1,024 by 1,024; only counts and the edges of a forest leave a block,
    so a large group of near copies never becomes pairs.  The rotations are learnt from at most 4,096
    vectors (those whose id hashes lowest); every vector is indexed.
    """
    scratch = Scratch(vectors.sparkSession, "near-vectors")
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    e = F.col("embedding")
    if kind == "<f8":
        e = e.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    digest = [F.xxhash64("embedding").alias("h1"), F.hash("embedding").alias("h2"), F.size("embedding").alias("size")]
    ids = scratch.store(rows.select("vec_id", "fine", *digest), "ids")
    copies = ids.where("fine").groupBy("h1", "h2", "size").agg(F.min("vec_id").alias("node"), F.count("*").alias("times"))
    copies = scratch.store(copies, "copies")
    firsts = rows.where("fine and vec_id is not null").select("vec_id", "embedding", *digest).join(
        copies.select("h1", "h2", "size", F.col("node").alias("vec_id"), "times"), ["h1", "h2", "size", "vec_id"]).dropDuplicates(["h1", "h2", "size"])
    nodes = scratch.store(firsts.select(F.col("vec_id").alias("node"), "times", "embedding", "size"), "nodes")

    links = scratch.spark.createDataFrame([], "a long, b long, links long")
    for r in nodes.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect():      # as a rule one length
        mine = nodes.where(F.col("size") == r["size"]).select("node", "times", "embedding")
        sample = mine.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").collect()
        bits, tables = table_plan(r["n"], cosine)
        x = unit(np.array([s.embedding for s in sample]))
        rotations = [learn_rotation(x, seed) for seed in range(math.ceil(bits * tables / r["size"]))]
        coded = scratch.store(_coded(mine, scratch.spark.sparkContext.broadcast((rotations, bits, tables)), kind), "coded")
        keyed = coded.select(F.explode("keys").alias("key"), "node", "times", "vec", "codes")
        shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        met = keyed.join(scratch.store(shared, "shared"), "key").withColumn("block", own)
        # block i meets blocks j >= i: a row goes to every block pair that its own block is in
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "times", "vec", "codes", "block")
        links = links.unionAll(scratch.store(_linked(met, cosine), "links"))
    edges = links.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    roots = components(edges, scratch)
    direct = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = scratch.store(copies.join(direct, "node", "left").join(roots, "node", "left").select(
        "h1", "h2", "size", F.lit(True).alias("fine"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("root", "node").alias("root")), "known")
    scratch.clear(ids, known)
    out = ids.join(known, ["h1", "h2", "size", "fine"], "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.95."""
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
