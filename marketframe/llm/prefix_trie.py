"""Prefix trie of conversations, built as burst tries.

Conversations are strings of turn ids.  Under the root, suffixes that begin with one turn share a
container.  A container that grows too large bursts: its common beginning becomes a head, a chain of
nodes, and its suffixes go on into containers by the turn that follows.  What remains is sorted and
swept into nodes, container by container, in one pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch, read_table

#: Suffixes (of distinct conversations, by blocks of ids) that a container holds before it bursts.
CONTAINER = 256
#: Conversations of one path are put together by blocks of so many ids.
BLOCK = 4096
#: What belongs to a conversation meets its turns by stretches of so many turns, as one may hold a third of all.
STRETCH = 4096
_ROOT = "unhex('')"
_NONE = hashlib.sha256().hexdigest()
_PATH = "array<struct<turn:binary,words:bigint>>"
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SWEPT = f"{_NODES}, heads array<binary>, head binary"


def placed_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, depth (from 1), turn (16 bytes for its role and text), words: each conversation's turns in order.

    Turns are ordered by ``turn`` (null first), then role and text; null role and text are empty; repeated rows are turns
    of their own; rows without conv_id are of no conversation.  Rows are dealt by ranges of conversation and turn and numbered
    within, so a conversation may span any number of tasks.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    turn = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", turn.alias("turn"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"), F.monotonically_increasing_id().alias("at"))
    numbered = scratch.store(sorted_rows.withColumn("part", F.shiftright("at", 33)), "numbered")
    parts = numbered.groupBy("conv_id", "part").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # a row per task
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return scratch.store(numbered.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first_at") + F.col("before") + 1).alias("depth"), "turn", "words"), "placed")


def _with_each(turns: DataFrame, facts: DataFrame, size: str) -> DataFrame:
    """``turns`` with the facts of their conversation, met by stretches; ``size``: its number of turns."""
    stretches = facts.withColumn("stretch", F.explode(F.sequence(F.lit(0), F.expr(f"cast({size} div {STRETCH} as int)"))))
    return turns.withColumn("stretch", F.expr(f"cast(depth div {STRETCH} as int)")).join(stretches, ["conv_id", "stretch"]).drop("stretch")


def shared_openings(turns: DataFrame, scratch: Scratch, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of the conversation whose id is the next lower multiple of ``every``
    (all if it has fewer, none if there is none), then the own turns after the first h; h = crc32(id) mod ``most``.

    Returns the new turns and conv_id, size of every conversation (0: none are left).
    """
    facts = turns.groupBy("conv_id").agg(F.max("depth").alias("n")).withColumn("base", F.expr(f"conv_id - conv_id % {every}"))
    facts = facts.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    heads = turns.where(f"conv_id % {every} = 0 and depth < {most}").groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("depth", "turn", "words"))).alias("head"))
    facts = facts.join(heads, "base", "left").withColumn("head", F.expr("slice(coalesce(head, array()), 1, cast(h as int))"))
    facts = scratch.store(facts.select("conv_id", "n", "h", "head", (F.size("head") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("size")), "openings")
    own = _with_each(turns, facts.select("conv_id", "n", "h", F.size("head").alias("opening")), "n").where("depth > h")
    own = own.select("conv_id", (F.col("opening") + F.col("depth") - F.col("h")).alias("depth"), "turn", "words")
    opening = facts.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.depth", "t.turn", "t.words")
    return scratch.store(own.unionByName(opening), "rebuilt"), facts.select("conv_id", "size")


class _Open:
    """A node of the sweep whose members are still coming, with the rows of its closed children."""

    def __init__(self, turn: bytes | None, words: int, depth: int):
        self.turn, self.words, self.depth = turn, words, depth
        self.n, self.first, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends, self.ended, self.rows = hashlib.sha256(), False, []

    def member(self, n: int, first: int, ids: str, goes_on: bool) -> None:
        self.join(n, first)
        if goes_on:                                         # alone from here on: its further turns are nodes already
            self.children += 1
            self.leaves += 1
        else:
            self.ends.update(("," + ids if self.ended else ids).encode())
            self.ended = True

    def join(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)

    def close(self, above: "_Open") -> list[list]:
        """Finished rows of the children; the node itself joins its parent."""
        self.saved += (self.n - 1) * self.words
        self.leaves = self.leaves or 1
        above.join(self.n, self.first)
        above.children += 1
        above.leaves += self.leaves
        above.saved += self.saved
        above.rows.append([self.first, self.depth, None, self.n, self.children, self.leaves, self.saved, self.ends.hexdigest()])
        return self.finished(self.first)

    def finished(self, conv_id: int | None) -> list[list]:
        for row in self.rows:
            row[2] = conv_id
        return self.rows


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted containers; only the rows of one container's open nodes are held."""
    fields = [*[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
              ("ends_sha256", pa.string()), ("heads", pa.list_(pa.binary())), ("head", pa.binary())]
    out: list[list] = []
    stack: list[_Open] = []
    container = None

    def shut(keep: int) -> None:
        while len(stack) > keep:
            closed = stack.pop()
            out.extend([*r, None, None] for r in closed.close(stack[-1]))

    def finish() -> None:
        if container is None:
            return
        shut(1)
        key, _, parent, heads = container
        if heads is None:                                   # conversations that end at the head ``key``
            out.append([None] * 7 + [stack[0].ends.hexdigest(), None, key])
        out.extend([*r, heads, None] for r in stack[0].finished(parent))

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])
        out.clear()
        return made

    for rows in batches:
        for r in rows.to_pylist():
            here = (r["key"], r["at"], r["parent"], r["heads"])
            if here != container:
                finish()
                container, stack = here, [_Open(None, 0, r["at"])]
            path, common = r["path"], 0
            while common < min(len(path), len(stack) - 1) and stack[common + 1].turn == path[common]["turn"]:
                common += 1
            shut(common + 1)
            for t in path[common:]:
                stack.append(_Open(t["turn"], t["words"], stack[-1].depth + 1))
            stack[-1].member(r["n"], r["first"], r["ids"], r["goes_on"])
            if len(out) > 1 << 14:
                yield batch()
    finish()
    yield batch()


def _suffixes(turns: DataFrame, cuts: DataFrame, sizes: DataFrame) -> DataFrame:
    """path, n, first, ids, goes_on: distinct conversations up to their ``cut``, with the ascending ids of a block."""
    shared = _with_each(turns, cuts, "size").where("depth <= coalesce(cut, size)")
    paths = shared.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "turn", "words"))).alias("t"), F.max(F.expr("coalesce(cut < size, false)")).alias("goes_on"))
    paths = paths.select("conv_id", F.expr("transform(t, x -> struct(x.turn as turn, x.words as words))").cast(_PATH).alias("path"), "goes_on")
    empty = sizes.where("size = 0").select("conv_id", F.array().cast(_PATH).alias("path"), F.lit(False).alias("goes_on"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    return (paths.unionByName(empty).groupBy("path", "goes_on", F.expr(f"floor(conv_id / {BLOCK})"))
            .agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), ids.alias("ids")).select("path", "n", "first", "ids", "goes_on"))


def prefix_trie(turns: DataFrame, sizes: DataFrame, scratch: Scratch, container: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, turn, words: one row for each conversation and depth).

    ``sizes`` (conv_id, size) also names conversations without turns.  A node is a distinct sequence of first
    turns: conv_id (its smallest member; with ``depth`` it names the node), parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (over its subtree, the words that members beyond the first repeat) and
    ends_sha256 (of the comma-joined ids that end here, ascending).  No conversations: no nodes.

    From the first turn that no other conversation has at its depth, a conversation is alone: these nodes are
    written row by row, and suffixes end there, whatever a conversation's length.  Equal suffixes are put together by blocks of
    ids before they meet.  ``container`` bounds what the sweep of a container holds; results don't depend on it.
    A path that many conversations share costs one burst, however long it is.
    """
    whole = sizes.agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).first()
    spark = turns.sparkSession
    if not whole.n:
        return spark.createDataFrame([], _NODES)
    alone = turns.groupBy("depth", "turn").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1").groupBy("conv_id").agg(F.min("depth").alias("cut"))
    cuts = scratch.store(sizes.where("size > 0").join(alone, "conv_id", "left"), "cuts")
    tails = _with_each(turns, cuts.where("cut < size"), "size").where("depth > cut").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.expr("cast(depth < size as long)").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") < F.col("size"), _NONE).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"))

    suffixes = scratch.store(_suffixes(turns, cuts, sizes).select(
        F.expr(f"if(size(path) > 0, path[0].turn, {_ROOT})").alias("key"), F.lit(0).cast("long").alias("at"), F.lit(whole.first).cast("long").alias("parent"),
        F.array(F.expr(_ROOT)).alias("heads"), "path", "n", "first", "ids", "goes_on"), "suffixes")
    pending, settled = suffixes.where("size(path) > 0"), []
    ended = [suffixes.where("size(path) = 0")]
    root = spark.range(1).select(F.expr(_ROOT).alias("key"), F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("parent"), F.array().cast("array<binary>").alias("heads"),
                                 F.array().cast(_PATH).alias("chain"), F.lit(whole.n).cast("long").alias("n"), F.lit(whole.first).cast("long").alias("first"))
    heads = [scratch.store(root, "root")]
    equal = "array_position(transform(sequence(1, least(size(low), size(high))), i -> low[i - 1].turn = high[i - 1].turn), false)"
    while True:
        full = pending.groupBy("key").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.min("first").alias("first"), F.min("path").alias("low"), F.max("path").alias("high"),
                                          *[F.min(c).alias(c) for c in ("at", "parent", "heads")]).where(F.col("rows") > container)
        # between the least and the greatest suffix lie all others: what these two share, all share
        chains = F.expr(f"slice(low, 1, cast(if({equal} = 0, least(size(low), size(high)), {equal} - 1) as int))")
        full = scratch.store(full.select("key", "at", "parent", "heads", chains.alias("chain"), "n", "first"), "heads")
        if full.isEmpty():
            settled.append(pending)
            break
        heads.append(full)
        settled.append(pending.join(full.select("key"), "key", "left_anti"))
        burst = pending.drop("parent").join(full.select("key", F.size("chain").alias("shared"), F.col("first").alias("parent")), "key")
        burst = scratch.store(burst.select(
            F.expr("if(size(path) > shared, unhex(md5(concat(key, path[shared].turn))), key)").alias("key"), (F.col("at") + F.col("shared")).alias("at"), "parent",
            F.concat("heads", F.array("key")).alias("heads"), F.expr("slice(path, shared + 1, size(path))").alias("path"), "n", "first", "ids", "goes_on"), "burst")
        ended.append(burst.where("size(path) = 0"))
        pending = burst.where("size(path) > 0")

    columns = ["key", "at", "parent", "heads", "path", "n", "first", "ids", "goes_on"]
    containers = None
    for part in [*settled, *[e.withColumn("heads", F.lit(None).cast("array<binary>")) for e in ended]]:
        containers = part.select(*columns) if containers is None else containers.unionByName(part.select(*columns))
    dealt = containers.repartition("key").sortWithinPartitions("key", "path", "first")
    swept = scratch.store(dealt.mapInArrow(_sweep, _SWEPT), "swept")
    nodes = swept.where("conv_id is not null").select(*tails.columns)
    return nodes.unionByName(tails).unionByName(_head_nodes(heads, swept))


def _head_nodes(heads: list[DataFrame], swept: DataFrame) -> DataFrame:
    """The nodes of the heads' chains, with the sums of what lies under them."""
    every = heads[0]
    for h in heads[1:]:
        every = every.unionByName(h)
    tops = swept.where("heads is not null")
    children = tops.select("heads").unionAll(every.select("heads")).select(F.try_element_at("heads", F.lit(-1)).alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("children"))
    ends = swept.where("head is not null").select(F.col("head").alias("key"), "ends_sha256")
    every = every.join(children, "key", "left").join(ends, "key", "left").withColumn("children", F.coalesce("children", F.lit(0)))
    every = every.withColumn("leaf", F.expr("cast(children = 0 as long)")).withColumn("repeated", F.expr("(n - 1) * aggregate(chain, 0L, (s, t) -> s + t.words)"))
    under = (tops.select(F.explode("heads").alias("key"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
             .unionAll(every.select(F.explode("heads").alias("key"), "leaf", "repeated")).unionAll(every.select("key", "leaf", F.lit(0).cast("long"))))
    every = every.join(under.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "key")
    # node i of a chain, from 1; the root is a chain's end without a chain
    nodes = every.select("*", F.explode(F.expr("sequence(if(size(chain) = 0, 0, 1), size(chain))")).alias("i"))
    last = F.col("i") == F.size("chain")
    return nodes.select(
        F.col("first").alias("conv_id"), (F.col("at") + F.col("i")).alias("depth"), F.expr("if(i <= 1, parent, first)").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.expr("saved + (n - 1) * aggregate(slice(chain, greatest(i, 1), size(chain)), 0L, (s, t) -> s + t.words)").alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(_NONE))).otherwise(_NONE).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """:func:`prefix_trie` of conversations (conv_id, turn, role, text) as they are; see :func:`placed_turns` for nulls,
    ties and repeated rows.  Other columns are not read; an empty table gives no nodes."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns = placed_turns(conversations, scratch)
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.max("depth").alias("size")), scratch, container)


def rebuilt_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """:func:`prefix_trie` of conversations rebuilt by :func:`shared_openings`."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns, sizes = shared_openings(placed_turns(conversations, scratch), scratch)
    return prefix_trie(turns, sizes, scratch, container)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return rebuilt_trie(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
digits AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
         list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT) AS codes
  FROM t GROUP BY conv_id),
convs AS (
  SELECT conv_id, base,
         xor(list_reduce(list_concat([4294967295::BIGINT], codes), lambda crc, code:
           list_reduce(list_concat([xor(crc, code)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
  FROM digits),
rows AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
paths AS (
  SELECT c.conv_id, coalesce(p.path, []) AS path, coalesce(p.words, []) AS words
  FROM convs c LEFT JOIN (
    SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY part, pos) AS path,
           list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY part, pos) AS words
    FROM rows GROUP BY conv_id) p ON p.conv_id = c.conv_id),
members AS (SELECT conv_id, path[1:d] AS key, d, len(path) = d AS at_end, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS last_words
            FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT key, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(last_words) AS last_words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM members GROUP BY key),
children AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
tree AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.key = n.key),
sums AS (
  SELECT key[1:d] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * last_words) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM tree) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM tree n JOIN sums s ON s.key = n.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1]
"""
