"""Licence scan with a positional index of rare licence words."""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import LOWER, UPPER, whole_text

# What separates words once A-Z count as letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a notice in order. ``key`` is the part that must stand in full; ``base`` asks for all of it."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_places(self) -> list[int]:
        wanted, words = self.key.split(), self.words
        start = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        return list(range(start, start + len(wanted)))


# Phrases that name a licence, and the wording of common notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", "license version 2"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", "license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license version", "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license version", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("mit-notice", "released under the mit license", "released under the mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """Words of a text, letters as they stand."""
    return F.filter(F.split(text, BETWEEN_WORDS), lambda w: w != "")


def small(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def licence_word_weights(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of each licence word over all documents.

    At most one row per word of the fixed templates reaches the driver.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_distinct(F.transform(F.filter(words_of(whole_text(text)), lambda w: F.lower(w).isin(vocabulary)), small))
    # The empty word counts the documents.
    counted = docs.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seen = {r["word"]: r["n"] for r in counted.collect()}
    rows = seen.get("", 0)
    return {w: math.log((1 + rows) / (1 + seen.get(w, 0))) + 1e-9 for w in vocabulary}


def rarest_word(template: Template, weights: dict[str, float]) -> str:
    return max(template.words, key=lambda w: (weights[w], w))


def _places(template: Template, weights: dict[str, float], share: float, words: Column, hits: Column) -> Column:
    """Starts of the template: where its rarest word stands, tested at that relative position."""
    listed, rare = template.words, rarest_word(template, weights)
    total = sum(weights[w] for w in listed)
    held = F.filter(hits, lambda h: h["word"] == rare)

    def starts(posting: int) -> Column:
        return F.transform(held, lambda h: h["at"] - F.lit(posting))

    def stands(start: Column, place: int) -> Column:
        return F.coalesce(small(F.get(words, start + F.lit(place))) == listed[place], F.lit(False))

    def found(start: Column) -> Column:
        sums = [F.when(stands(start, p), F.lit(weights[w])).otherwise(F.lit(0.0)) for p, w in enumerate(listed)]
        return reduce(operator.add, sums) / F.lit(total)

    def holds(start: Column) -> Column:
        return reduce(operator.and_, [start >= 0, *(stands(start, p) for p in template.key_places)])

    kept = F.filter(F.array_distinct(F.concat(*[starts(p) for p, w in enumerate(listed) if w == rare])), lambda s: holds(s))
    rated = F.transform(
        kept,
        lambda s: F.struct(F.lit(template.label).alias("label"), F.lit(template.base).alias("base"), s.cast("long").alias("start"), found(s).alias("score")),
    )
    return F.filter(rated, lambda r: r["score"] >= share)


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, share: float = 0.6) -> DataFrame:
    """Places of licence phrases and notices in whole texts: (doc_id, n_words, places).

    Licence words are weighed by their inverse document frequency over all documents. A file's words are looked up
    in the index of each template's rarest word; every hit fixes a relative position, at which the template's
    other words are intersected. A place counts when its key phrase stands in full and at least ``share`` of the
    template's weight agrees. ``places`` holds label, base, start (word number from 0) and score.

    One row per input row. A null text is an empty one and has no word or place; null ids are returned as they
    are; repeated rows give repeated results; an empty table gives no rows. Only the two named columns are read.
    """
    weights = licence_word_weights(docs, text, templates)
    rare = sorted({rarest_word(t, weights) for t in templates})
    read = docs.select(F.col(doc_id).alias("doc_id"), words_of(whole_text(text)).alias("_words"))
    hit = F.transform(F.col("_words"), lambda w, i: F.when(F.lower(w).isin(rare), F.struct(i.alias("at"), small(w).alias("word"))))
    marked = read.select("doc_id", "_words", F.filter(hit, lambda h: h.isNotNull()).alias("_hits"))
    places = F.concat(*[_places(t, weights, 1.0 - 1e-9 if t.base else share, F.col("_words"), F.col("_hits")) for t in templates])
    # Nearly all files have no hit and skip the templates.
    some = F.when(F.size("_hits") > 0, places)
    return marked.select("doc_id", F.size("_words").cast("long").alias("n_words"), some.alias("_places")).select(
        "doc_id", "n_words", F.coalesce("_places", F.expr("cast(array() as array<struct<label:string,base:boolean,start:bigint,score:double>>)")).alias("places")
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place of the base phrases, and labels per document."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def joined(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)), 6).alias("score"),
    )


def license_sql(templates: tuple[Template, ...] = TEMPLATES, share: float = 0.6) -> str:
    """The same result in DuckDB SQL."""
    rows = ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {p}, '{w}', {str(t.base or p in t.key_places).lower()})" for n, t in enumerate(templates) for p, w in enumerate(t.words)
    )
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), t(n, label, base, p, word, needed) AS (VALUES {rows}),
v AS (SELECT DISTINCT word FROM t),
seen AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(words) AS word FROM d) JOIN v USING (word) GROUP BY word),
idf AS (SELECT v.word, ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df, 0))) + 1e-9 AS weight FROM v LEFT JOIN seen USING (word)),
tw AS (SELECT t.*, weight, sum(weight) OVER (PARTITION BY n) AS total, sum(CAST(needed AS INT)) OVER (PARTITION BY n) AS needs,
         first_value(word) OVER (PARTITION BY n ORDER BY weight DESC, word DESC) AS rare FROM t JOIN idf USING (word)),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
hit AS (
  SELECT doc_id, n, i - p AS start, sum(weight) / any_value(total) AS score
  FROM w JOIN tw USING (word) WHERE i >= p GROUP BY doc_id, n, i - p
  HAVING bool_or(word = rare) AND sum(CAST(needed AS INT)) = any_value(needs)
), place AS (
  SELECT DISTINCT doc_id, label, base, start, score FROM hit JOIN (SELECT DISTINCT n, label, base FROM t) USING (n) WHERE score >= CASE WHEN base THEN 1.0 - 1e-9 ELSE {share} END
), s AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM place GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 6) AS score
FROM d LEFT JOIN s USING (doc_id)"""
