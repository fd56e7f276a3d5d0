"""Phrases whose words stand together more often than apart: mining of collocations by HAT-trie counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch, read_table, row_slices, text_buffer
from marketframe.llm.hat_trie import HatTrie, Rows
from marketframe.llm.textscan import mixed, scan_words, word_hashes

LONGEST, LEAST, TOP, COVERED = 4, 30, 2000, 80
#: Phrases of up to so many words are counted by their hashes first.
FILTERED = 3
#: Bytes that end a piece, and those that are in words.
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
IN_WORDS = ~ENDS
IN_WORDS[[9, 32]] = False
#: A document's mark is one of 128, by its words.  Each frequent word, pair and triple is spelled out only from the documents of the
#: greatest mark among those that hold it, not by every task that meets it.
MARKS = 128
_MARK_BITS = MARKS.bit_length() - 1
_NOTE_BITS = _MARK_BITS + 2                                 # of a count: a mark below the size of the phrase
_NOTE = (1 << _NOTE_BITS) - 1
_SPREAD = 0x0101010101010101                                # times a mark: each byte is the mark
#: The filters of frequent pairs, of frequent triples, and of frequent words, pairs and triples with their marks, have 16 bits for each
#: of them, and at most so many (32 MB): beyond, they let more infrequent phrases through, which are dropped by their counts.
MOST_FILTER_BITS = 1 << 28
_SLICE = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RUN = f"gram long, lang string, {', '.join(f'w{i} long' for i in range(1, LONGEST + 1))}, n long, word string"


@dataclass
class Grams:
    """Words of a slice of documents: their hashes (0 is no word's), that of their documents' languages, their documents'
    marks, and how many words of the same piece follow each, up to ``LONGEST`` - 1."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    lang: np.ndarray
    mark: np.ndarray
    follow: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> "Grams":
        folded, starts, ends, first = scan_words(data, offsets, IN_WORDS)
        words = word_hashes(folded, starts, ends)
        words[words == 0] = 1
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words)])
        marks = mixed(total[first[1:]] - total[first[:-1]]) % np.uint64(MARKS)
        piece = np.concatenate([[0], np.cumsum(ENDS[folded])])[starts] if len(starts) else starts
        linked = np.zeros(len(words), bool)
        linked[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        follow = np.zeros(len(words), np.int8)
        for _ in range(LONGEST - 1):
            follow[:-1] = np.where(linked[:-1], np.minimum(follow[1:] + 1, LONGEST - 1), 0)
        return cls(folded, starts, ends, words, langs[row], marks[row], follow)

    def keys(self, longest: int = FILTERED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrases of one word, two, up to ``longest``: where they begin, and hashes of them with their language."""
        at, keys = np.arange(len(self.words)), mixed(self.lang * _FACTOR + self.words)
        yield at, keys
        for size in range(2, longest + 1):
            goes_on = self.follow[at] >= size - 1
            at = at[goes_on]
            keys = mixed(keys[goes_on] * np.uint64(31) + self.words[at + size - 1])
            yield at, keys


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, dict[int, str]]]:
    """The words of about 4 MB of text at a time, and the languages by their hashes."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        lang_data, lang_offsets = text_buffer(batch.column(0))
        langs = word_hashes(lang_data, lang_offsets[:-1], lang_offsets[1:])
        distinct, at = np.unique(langs, return_index=True)
        names = dict(zip(distinct.tolist(), batch.column(0).take(pa.array(at)).to_pylist()))
        for i, j in row_slices(offsets, _SLICE):
            yield Grams.of(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], langs[i:j]), names


def _batch(columns: list, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _cast(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _noted(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of counts, with the greatest of their notes."""
    return np.add.reduceat(counts & ~_NOTE, first) | np.maximum.reduceat(counts & _NOTE, first)


@dataclass
class Filter:
    """A Bloom filter with two bits for each hash."""

    words: np.ndarray

    @classmethod
    def of(cls, grams: DataFrame, most_bits: int) -> "Filter":
        bits = 1 << 12
        while bits < min(most_bits, 16 * grams.count()):
            bits *= 2
        place = F.explode(F.array(F.col("gram").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("gram", 32).bitwiseAND(F.lit(bits - 1))))
        mine = grams.select(place.alias("p")).select(F.shiftright("p", 6).alias("at"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
        set_bits = mine.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()     # at most bits / 64 rows
        words = np.zeros(bits // 64, np.uint64)
        words[set_bits["at"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
        return cls(words)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        mask = np.uint64(64 * len(self.words) - 1)
        for place in (keys & mask, keys >> np.uint64(32) & mask):
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _frequent(texts: DataFrame, shortest: int, longest: int, least: int, budget: int, burst: int, parts: Filter | None = None) -> DataFrame:
    """Hashes (``gram``) of the phrases of ``shortest`` to ``longest`` words, with their language, that occur ``least`` times or
    more, with their counts ``a``, numbers of words ``size`` and the greatest ``mark`` of documents that hold them.

    ``parts`` is a filter of the frequent phrases of one word less than ``shortest``: only phrases whose two such parts pass
    are counted, as a phrase occurs no more often than any part."""
    sent = texts.sparkSession.sparkContext.broadcast(parts)
    fields = [("gram", pa.int64()), ("n", pa.int64())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, trie = sent.value, HatTrie(1, budget, burst, _noted)
        for grams, _ in _slices(batches):
            keys, counts, marks, passes = [], [], grams.mark.view(np.int64), np.zeros(len(grams.words), bool)
            for size, (at, k) in enumerate(grams.keys(longest), 1):
                if size < shortest:
                    if parts and size == shortest - 1:
                        passes[at[parts.passes(k)]] = True
                    continue
                if parts:
                    both = passes[at] & passes[at + size - shortest + 1]
                    at, k = at[both], k[both]
                keys.append(k)
                counts.append(marks[at] | (1 << _NOTE_BITS | size << _MARK_BITS))
            for (run,), n in trie.add([np.concatenate(keys)], np.concatenate(counts)):
                yield _batch([_cast(run), n], fields)
        for (run,), n in trie.spill():
            yield _batch([_cast(run), n], fields)

    # tasks have put equal hashes together already, so runs are dealt before Spark sums them up
    counted = texts.mapInArrow(count, "gram long, n long").repartition("gram")
    summed = counted.groupBy("gram").agg(F.sum(F.shiftright("n", _NOTE_BITS)).alias("a"), F.max(F.col("n").bitwiseAND(F.lit(_NOTE))).alias("note"))
    return summed.where(F.col("a") >= least).select(
        "gram", "a", F.shiftright("note", _MARK_BITS).alias("size"), F.col("note").bitwiseAND(F.lit(MARKS - 1)).alias("mark"))


def _runs(texts: DataFrame, triples: Filter, marked: Filter, budget: int, burst: int) -> DataFrame:
    """Rows of the words of frequent words, pairs and triples, and sorted runs of counts of longer phrases: the hash of a
    phrase of up to three words (null of others), language, the hashes of one to four words (0: none), n, and the text of a single word.

    The former are sent once a task, from documents of their mark, and without counts: those are known by hash.  The latter are
    counted if all their triples pass the filter: a phrase occurs no more often than any part.  A row without words counts all words of
    its language.
    """
    sent = texts.sparkSession.sparkContext.broadcast((triples, marked))
    fields = [("gram", pa.int64()), ("lang", pa.string()), *[(f"w{i}", pa.int64()) for i in range(1, LONGEST + 1)], ("n", pa.int64()), ("word", pa.string())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (triples, marked), trie, names = sent.value, HatTrie(1 + LONGEST, budget, burst), {}
        known = np.zeros(0, np.uint64)                      # hashes whose words this task has sent

        def written(run: Rows) -> Iterator[pa.RecordBatch]:
            (lang, *words), n = run
            for i in range(0, len(n), 1 << 16):
                part = slice(i, i + (1 << 16))
                none = [None] * len(n[part])
                yield _batch([none, [names[x] for x in lang[part].tolist()], *[_cast(w[part]) for w in words], n[part], none], fields)

        for grams, here in _slices(batches):
            names |= here
            spread, passes, found = grams.mark * np.uint64(_SPREAD), np.zeros(len(grams.words), bool), []
            for size, (at, keys) in enumerate(grams.keys(), 1):
                mine = marked.passes(keys ^ spread[at])
                found.append((keys[mine], at[mine], np.full(mine.sum(), size)))
                if size == FILTERED:
                    passes[at[triples.passes(keys)]] = True
            keys, at, sizes = (np.concatenate(x) for x in zip(*found))
            distinct, first = np.unique(keys, return_index=True)
            new = ~np.isin(distinct, known)
            if new.any():
                at, sizes = at[first[new]], sizes[first[new]]
                words = [np.where(k < sizes, grams.words[np.minimum(at + k, len(grams.words) - 1)], np.uint64(0)) for k in range(LONGEST)]
                text = [grams.data[a:b].tobytes().decode("utf-8", "replace") if size == 1 else None
                        for a, b, size in zip(grams.starts[at].tolist(), grams.ends[at].tolist(), sizes.tolist())]
                yield _batch([_cast(distinct[new]), [names[x] for x in grams.lang[at].tolist()], *map(_cast, words), np.zeros(len(at), np.int64), text], fields)
                known = np.union1d(known, distinct[new]) if len(known) < budget else distinct[new]
            langs, n_words = np.unique(grams.lang, return_counts=True)
            none = [np.zeros(len(langs), np.uint64)] * LONGEST
            for run in trie.add([langs, *none], n_words):
                yield from written(run)
            at = np.flatnonzero(passes)
            for size in range(FILTERED + 1, LONGEST + 1):   # both parts with one word less pass
                at = at[grams.follow[at] >= size - 1]
                at = at[passes[at + size - FILTERED]]
                words = [grams.words[at + k] if k < size else np.zeros(len(at), np.uint64) for k in range(LONGEST)]
                for run in trie.add([grams.lang[at], *words], np.ones(len(at), np.int64)):
                    yield from written(run)
        for run in trie.spill():
            yield from written(run)

    return texts.mapInArrow(count, _RUN)


def _scored(phrases: DataFrame, covered: int) -> DataFrame:
    """lang, words, a, l, r, score of the candidates (phrases of two words and more) that no longer one covers."""
    candidates = phrases.where(F.size("words") > 1)
    cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first_part", F.expr("slice(words, 1, k)")).withColumn("rest", F.expr("slice(words, k + 1, size(words) - k)"))
    for part, name in (("first_part", "l"), ("rest", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("words").alias(part), F.col("a").alias(name)), ["lang", part])
    cuts = cuts.withColumn("score", F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    best = cuts.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))")
    longer = candidates.where(F.size("words") > 2).select("lang", F.explode(parts).alias("words"), F.col("a").alias("longer")).groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    kept = best.join(longer, ["lang", "words"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer").cast("decimal(19,0)") < F.lit(covered) * F.col("a").cast("decimal(19,0)")))
    return kept.select("lang", "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, most_filter_bits: int = MOST_FILTER_BITS,
                 budget: int = 1 << 20, burst: int = 1 << 15) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the ``top`` phrases of two to four words by score.

    A-Z are lower-cased; texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and
    tabs; phrases don't cross pieces.  a, l and r are the occurrences of the phrase (``least`` or more) and of the two
    parts of its weakest cut, n those of all words; score is floor(2000000 * a / (l + r)).  Phrases inside a
    longer one with ``covered`` percent of their occurrences are left out.  Null texts are empty, a null lang is ``und``;
    repeated rows count each; other columns are not read; an empty table gives no rows.

    Words, pairs and triples are compared by 64 bits, longer phrases by 64 bits for each word.  Tasks count in HAT-tries of bounded
    memory, first the hashes of all words and pairs, then those of triples made of frequent pairs, then the longer phrases made of
    frequent triples, and spill sorted runs; runs are merged by the whole phrase, as a prefix can hold a third of all.  The words of a
    frequent pair or triple are read from the documents of one mark.  ``budget``, ``burst`` and ``most_filter_bits`` change memory and speed alone.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    frequent = scratch.store(_frequent(texts, 1, FILTERED - 1, least, budget, burst), "frequent")
    pairs = Filter.of(frequent.where(F.col("size") == FILTERED - 1).select("gram"), most_filter_bits)
    longest = scratch.store(_frequent(texts, FILTERED, FILTERED, least, budget, burst, pairs), "triples")
    triples = Filter.of(longest.select("gram"), most_filter_bits)
    frequent = frequent.unionByName(longest)
    marked = Filter.of(frequent.select(F.col("gram").bitwiseXOR(F.col("mark") * F.lit(_SPREAD)).alias("gram")), most_filter_bits)
    runs = scratch.store(_runs(texts, triples, marked, budget, burst), "runs")
    hashes = [f"w{i}" for i in range(1, LONGEST + 1)]
    short = runs.where("gram is not null").select("gram", "lang", *hashes).distinct().join(frequent.select("gram", "a"), "gram").drop("gram")
    longer = runs.where("gram is null").groupBy("lang", *hashes).agg(F.sum("n").alias("a")).where((F.col("a") >= least) | (F.col("w1") == 0))
    merged = short.select("lang", *hashes, "a").unionByName(longer)
    merged = scratch.store(merged.select("lang", F.array_remove(F.array(*hashes), 0).alias("words"), "a"), "phrases")
    totals = merged.where(F.size("words") == 0).select("lang", F.col("a").alias("n"))
    scored = _scored(merged.where(F.size("words") > 0), covered)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = scratch.store(scored.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place"), "first")     # ties too
    places = first.select("lang", "words", F.posexplode("words").alias("i", "w"))
    text_of = runs.where("word is not null").select(F.col("w1").alias("w"), "word").join(places.select("w").distinct(), "w", "left_semi").groupBy("w").agg(F.min("word").alias("word"))
    spelled = places.join(text_of, "w").groupBy("lang", "words").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("spelled"))
    phrases = first.join(spelled.select("lang", "words", F.array_join("spelled.word", " ").alias("phrase")), ["lang", "words"]).join(totals, "lang")
    ranked = phrases.withColumn("rank", F.row_number().over(order.orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all documents."""
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed),
grams AS (SELECT lang, w[i:i + m - 1] AS words FROM placed, (VALUES (1), (2), (3), (4)) s(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, words, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(len(w)) AS n FROM listed GROUP BY lang),
candidates AS (SELECT * FROM f WHERE a >= 30 AND len(words) > 1),
cuts AS (
  SELECT c.lang, c.words, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
parts AS (SELECT lang, words, a, unnest(range(2, len(words))) AS m FROM candidates WHERE len(words) > 2),
inside AS (SELECT lang, words[i:i + m - 1] AS words, max(a) AS longer FROM (SELECT *, unnest(range(1, len(words) - m + 2)) AS i FROM parts) GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.words, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.words = b.words
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
"""
