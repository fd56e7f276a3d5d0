"""Licence scan with DataFrame functions only: a positional index of templates, probed by rare words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import read_table

# The key phrases that carry a licence's label by themselves.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening passages of common licences with the label and the key phrase that must stand in them.
TEMPLATES = [
    ("gpl", "gnu general public license", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]

#: Share of a template's words that must stand at their places for its label.
COVERAGE = 0.8
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Words of a text (null: none): runs of digits, ASCII letters and non-ASCII characters, A-Z lower-cased.

    ``lower`` also folds other letters, which no template has, but for the Kelvin
    sign, whose fold is an ASCII letter: it is replaced by another letter first.
    """
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("æ")))
    return F.array_remove(F.split(folded, _NOT_WORD), "")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many rows of ``words`` hold each licence word; one number per word of the templates comes back."""
    seen = words.select(F.explode(F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]))).alias("word"))
    return {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``license_scan``: struct of n_words, base_places (phrase label and first word),
    base_labels, labels (sorted arrays) and score.

    Every template is indexed under the word of its key phrase that is rarest over
    the whole table; each place of such a word in a file proposes one alignment of
    the template.  There the key phrase must match word for word, and the share of
    the template's words at their places is its coverage.  Base phrases are
    templates that are all key phrase.  ``score`` is 1 with a base place, else the best
    coverage at an alignment with its key phrase, else 0.  As key phrases match whole,
    no place is missed.  Null and empty texts have no words, places or labels (score 0);
    repeated rows are scanned alike; an empty table gives no rows; a column of ``docs``
    that is itself called ``license_scan`` is replaced.
    """
    words = license_words(F.col(f"`{text}`"))
    index = [("base", label, phrase.split(), phrase.split()) for phrase, label in BASE_PHRASES.items()]
    index += [("template", label, key.split(), body.split()) for label, key, body in TEMPLATES]
    vocabulary = sorted({w for _, _, key, _ in index for w in key})
    frequency = document_frequencies(docs.select(words.alias("words")), vocabulary)
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, _, key, body) in enumerate(index):
        rarest = min(key, key=lambda w: (frequency.get(w, 0), w))
        start = next(i for i in range(len(body)) if body[i: i + len(key)] == key)
        postings.setdefault(rarest, []).append((t, start + key.index(rarest)))

    lookup = F.create_map(*[x for w, found in sorted(postings.items()) for x in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in found]))])
    table = F.array(*[F.struct(F.lit(kind == "base").alias("base"), F.lit(label).alias("label"), _array(key).alias("key"), _array(body).alias("body"),
                               F.lit(next(i for i in range(len(body)) if body[i: i + len(key)] == key)).alias("key_at")) for kind, label, key, body in index])

    def alignments(all_words: Column) -> Column:
        """Each place of an indexed word, for each template listed under it: template and first word."""
        probes = F.array_compact(F.transform(all_words, lambda w, i: F.when(w.isin(*postings), F.struct(w.alias("w"), i.alias("i")))))
        return F.flatten(F.transform(probes, lambda h: F.transform(
            F.try_element_at(lookup, h["w"]), lambda p: F.struct(F.get(table, p["t"]).alias("of"), (h["i"] - p["p"]).alias("at")))))

    def has_key(all_words: Column, a: Column) -> Column:
        begin = a["at"] + a["of"]["key_at"]
        return (begin >= 0) & (F.slice(all_words, F.greatest(begin, F.lit(0)) + 1, F.size(a["of"]["key"])) == a["of"]["key"])

    def coverage(all_words: Column, a: Column) -> Column:
        same = F.transform(a["of"]["body"], lambda w, j: F.when((a["at"] + j >= 0) & (F.get(all_words, F.greatest(a["at"] + j, F.lit(0))) == w), 1).otherwise(0))
        return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.size(a["of"]["body"])

    w, scan = F.col("_scan.words"), F.col("_scan.found")
    found = F.transform(F.filter(alignments(w), lambda a: has_key(w, a)), lambda a: F.struct(
        a["of"]["base"].alias("base"), a["of"]["label"].alias("label"), a["at"].alias("at"), coverage(w, a).alias("coverage")))
    base = F.filter(scan, lambda a: a["base"])
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda a: a["label"])))
    labels = F.array_sort(F.array_distinct(F.transform(F.filter(scan, lambda a: a["base"] | (a["coverage"] >= COVERAGE)), lambda a: a["label"])))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "license_scan"]
    step = docs.select(F.struct(*rest).alias("_row"), F.struct(words.alias("words")).alias("_scan"))
    step = step.select("_row", F.struct(F.size(w).cast("long").alias("n_words"), found.alias("found")).alias("_scan"))
    scanned = F.struct(F.col("_scan.n_words").alias("n_words"), F.transform(base, lambda a: F.struct(a["label"], a["at"].cast("long").alias("at"))).alias("base_places"),
                       base_labels.alias("base_labels"), labels.alias("labels"),
                       F.coalesce(F.array_max(F.transform(scan, lambda a: a["coverage"])), F.lit(0.0)).alias("score"))
    return step.select("_row", scanned.alias("license_scan")).select("_row.*", "license_scan")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    scan = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.transform("license_scan.base_places", lambda p: p["at"])
    return scan.select("doc_id", F.col("license_scan.n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
                       F.array_join("license_scan.base_labels", ",").alias("base_labels"), F.array_join("license_scan.labels", ",").alias("labels"),
                       F.col("license_scan.score").alias("score"))


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEYS = ", ".join([f"(true, '{label}', {_sql_list(p.split())}, {_sql_list(p.split())})" for p, label in BASE_PHRASES.items()]
                  + [f"(false, '{label}', {_sql_list(key.split())}, {_sql_list(body.split())})" for label, key, body in TEMPLATES])

OP7_SQL = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tmpl(base, label, key, body) AS (VALUES {_KEYS}),
placed AS (SELECT *, list_filter(range(1, len(body) + 1), lambda j: body[j:j + len(key) - 1] = key)[1] AS key_at FROM tmpl),
word AS (SELECT doc_id, w, unnest(w) AS one, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (SELECT p.base, p.label, d.doc_id, d.i - p.key_at AS spot,
               list_sum(list_transform(range(1, len(p.body) + 1), lambda j: CASE WHEN d.i - p.key_at + j >= 1 AND d.w[d.i - p.key_at + j] = p.body[j] THEN 1 ELSE 0 END)) / len(p.body) AS coverage
        FROM word d JOIN placed p ON d.one = p.key[1] AND d.w[d.i:d.i + len(p.key) - 1] = p.key),
agg AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(spot) FILTER (base) AS first_word, max(spot) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR coverage >= {COVERAGE}) AS labels, max(coverage) AS score
        FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM doc d LEFT JOIN agg USING (doc_id)
"""
