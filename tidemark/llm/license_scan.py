"""License scans by diagonal voting, in DataFrame functions only.

Every rolling run of ``GRAM`` words of every text is joined to the positions of
that run in the license templates. A hit votes for the diagonal ``position in
the text - position in the template``; a quoted license puts its votes on one
diagonal, an inserted or left-out word moves them to a neighbouring one. Votes
are summed by diagonal, diagonals at most ``DRIFT`` apart are merged, and a
merged span is verified: it must hold at least ``LEAST_SHARE`` percent of the
template's runs in at most twice its length.

The templates are a fixed text of a few hundred runs, so they are broadcast;
the words of a text never leave its row but for the runs that may hit. Only
votes are shuffled, summed per (document, template, diagonal) on the map side
first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5
DRIFT = 4
LEAST_SHARE = 50

# Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The opening words of public license notices.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction including without limitation "
           "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
              "with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 3 of the license or at your "
           "option any later version",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met redistributions of source code must retain the above copyright notice "
           "this list of conditions and the following disclaimer",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
           "not distributed with this file you can obtain one at",
}


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def run_hashes(words: Column) -> Column:
    """The hash of every rolling run of ``GRAM`` words, by the run's place."""
    n = F.size(words) - (GRAM - 1)
    return F.when(n > 0, F.transform(F.slice(words, F.lit(1), F.greatest(n, F.lit(1))), lambda w, i: F.struct(
        i.alias("pos"), F.xxhash64(w, *(F.get(words, i + j) for j in range(1, GRAM))).alias("h"))))


def runs_at(words: Column, places: Column) -> Column:
    """(pos, h, run) with the words of the runs at some places."""
    return F.transform(places, lambda p: F.struct(
        p["pos"].alias("pos"), p["h"].alias("h"), F.array_join(F.slice(words, p["pos"] + 1, GRAM), " ").alias("run")))


def phrase_places(words: Column) -> Column:
    """(start, label) wherever a phrase's words stand one after another."""
    def places(phrase: str, label: str) -> Column:
        first, *rest = phrase.split()
        stands = lambda w, i: (w == first) & F.forall(
            F.array(*(F.coalesce(F.get(words, i + j + 1) == r, F.lit(False)) for j, r in enumerate(rest))), lambda x: x)
        marked = F.transform(words, lambda w, i: F.when(
            stands(w, i), F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))))
        return F.filter(marked, lambda x: x.isNotNull())
    return F.concat(*(places(p, label) for p, label in PHRASES.items()))


def template_runs(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """label, tpos, h, run and the template's number of runs and words."""
    values = ", ".join(f"('{label}', '{text}')" for label, text in templates.items())
    t = spark.sql(f"SELECT * FROM VALUES {values} AS t(label, template)").withColumn("words", words_of(F.col("template")))
    return t.select("label", F.size("words").alias("t_words"), (F.size("words") - (GRAM - 1)).alias("t_runs"),
                    F.inline(runs_at(F.col("words"), run_hashes(F.col("words"))))).withColumnRenamed("pos", "tpos")


def template_spans(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """Merged spans of template text: doc_id, label, first and last word, votes,
    share (of the template's runs), verified.

    All rolling runs are hashed; those whose hash no template has cannot join
    and are left out within the row, so only possible hits become rows."""
    known = template_runs(docs.sparkSession, templates)
    hashes = [r[0] for r in known.select("h").distinct().collect()]  # of the fixed templates
    runs = docs.where("doc_id is not null").select("doc_id", F.inline(_bound(words_of(F.col("text")), lambda words: runs_at(
        words, F.filter(run_hashes(words), lambda p: p["h"].isin(*hashes))))))
    hits = runs.join(F.broadcast(known.withColumnRenamed("run", "t_run")), "h").where("run = t_run")
    votes = hits.groupBy("doc_id", "label", "t_words", "t_runs", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.collect_set("tpos").alias("tposes"))
    by_diagonal = Window.partitionBy("doc_id", "label").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > DRIFT
    merged = votes.withColumn("span", F.sum(F.coalesce(apart.cast("int"), F.lit(0))).over(by_diagonal)).groupBy(
        "doc_id", "label", "t_words", "t_runs", "span").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("tposes")))).alias("found"))
    return merged.select(
        "doc_id", "label", "first", "last", "votes", (F.col("found") / F.col("t_runs")).alias("share"),
        ((100 * F.col("found") >= LEAST_SHARE * F.col("t_runs"))
         & (F.col("last") - F.col("first") + 1 <= 2 * F.col("t_words"))).alias("verified"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Labels of every document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and the number of verified ``spans``.

    ``score`` is 1 where a phrase names a license, else the largest share of a
    template found. A null text is an empty one; a document without doc_id has
    base labels only; rows that share a doc_id share their template labels.
    Other columns are not read; an empty table gives no rows.
    """
    spans = template_spans(docs.select("doc_id", "text"), templates).groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("found"), F.max("share").alias("share"),
        F.count(F.when(F.col("verified"), 1)).alias("spans"))
    place = "array<struct<start:bigint,label:string>>"
    base = docs.select("doc_id", _bound(words_of(F.col("text")), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.when(F.array_contains(words, "license"), phrase_places(words)).otherwise(F.array().cast(place)).alias("places"))).alias("b"))
    base = base.select("doc_id", "b.*").withColumn("base", F.array_distinct(F.col("places.label")))
    rows = base.join(spans, "doc_id", "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("spans"))


ORACLE = f"""
WITH t(label, template) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())}),
tw AS (SELECT label, string_split(template, ' ') AS w FROM t),
tr AS (
  SELECT label, len(w) AS t_words, len(w) - {GRAM - 1} AS t_runs, i - 1 AS tpos, array_to_string(w[i:i + {GRAM - 1}], ' ') AS run
  FROM (SELECT label, w, unnest(generate_series(1, len(w) - {GRAM - 1})) AS i FROM tw) s),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
e AS (SELECT r, doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d),
p AS (
  SELECT r, i - 1 AS start, CASE WHEN w[i] = 'mit' THEN 'mit' WHEN w[i] = 'apache' THEN 'apache' ELSE 'gpl' END AS label
  FROM e WHERE (w[i] IN ('mit', 'apache') AND w[i + 1] = 'license')
            OR (w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license')),
base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS ls FROM p GROUP BY r),
hits AS (
  SELECT doc_id, label, t_words, t_runs, i - 1 AS pos, tpos
  FROM (SELECT doc_id, i, array_to_string(w[i:i + {GRAM - 1}], ' ') AS run FROM e WHERE i + {GRAM - 1} <= len(w)) s JOIN tr USING (run)),
dd AS (SELECT DISTINCT doc_id, label, pos - tpos AS diagonal FROM hits),
marked AS (
  SELECT *, sum(CASE WHEN diagonal - before > {DRIFT} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS span
  FROM (SELECT *, lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS before FROM dd) s),
spans AS (
  SELECT h.doc_id, h.label, m.span, h.t_words, h.t_runs, count(DISTINCT tpos) AS found, min(pos) AS first_pos, max(pos) + {GRAM - 1} AS last_pos
  FROM hits h JOIN marked m ON m.doc_id = h.doc_id AND m.label = h.label AND m.diagonal = h.pos - h.tpos
  GROUP BY ALL),
per_doc AS (
  SELECT doc_id, max(found / t_runs) AS share,
         list(DISTINCT label) FILTER (100 * found >= {LEAST_SHARE} * t_runs AND last_pos - first_pos + 1 <= 2 * t_words) AS found,
         count(*) FILTER (100 * found >= {LEAST_SHARE} * t_runs AND last_pos - first_pos + 1 <= 2 * t_words) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(ls, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), coalesce(found, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score, coalesce(spans, 0) AS spans
FROM d LEFT JOIN base ON base.r = d.r LEFT JOIN per_doc ON per_doc.doc_id = d.doc_id
"""
