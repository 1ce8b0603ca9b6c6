"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a line of a text; with ``wrapped``, the words around each line break are blocks as well, as
many on each side as the longest template has, so that every notice wrapped over lines lies whole
in the block of each of its breaks. A block and a template are sets of words. A block holds a template
if it contains at least the share ``threshold`` of the template's words. With needed overlap
c = ceil(threshold * size of the template) the join rests on three filters, none of which loses a
pair:

* prefix: words are ordered by how many blocks of the whole corpus hold them, rarest first. Of c
  common words at least one lies among the first (size - c + 1) words of the template;
* length: a block with fewer than c words of any template is dropped;
* positional: after a match at place i of the template and j of the block, at most
  1 + min(rest of the template, rest of the block) words can be common.

Words that no template has cannot match, so blocks are kept as their words that some template has,
in the same order. Everything is DataFrame operations; the templates are a small parameter.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import sized, stored, text_key

THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    """Text that stands for a license."""
    label: str
    text: str


# Phrases with their labels, and short public notices that name a license.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                    "software and associated documentation files"),
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
                    "the GNU General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
                    "permitted provided that the following conditions are met"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

#: Notices of a few words that name a license by its short name, for callers that want them labelled.
SHORT_NOTICES = (
    Template("cc", "Licensed under CC BY 4.0"),
    Template("cc", "Licensed under CC BY-SA 4.0"),
    Template("cc", "Licensed under CC BY-NC 4.0"),
    Template("cc", "Licensed under CC BY-ND 4.0"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column | str) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _BREAK), "")


def template_rows(spark: SparkSession, templates: tuple[Template, ...], threshold: float) -> DataFrame:
    """(template, label, words, length, size, need) with distinct words; the length counts repeated ones."""
    schema = T.StructType([T.StructField("template", T.IntegerType()), T.StructField("label", T.StringType()),
                           T.StructField("text", T.StringType())])
    rows = spark.createDataFrame([(i, t.label, t.text) for i, t in enumerate(templates)], schema)
    return (rows.select("template", "label", F.array_distinct(words_of("text")).alias("words"),
                        F.size(words_of("text")).alias("length"))
            .withColumn("size", F.size("words")).filter("size > 0")
            .withColumn("need", F.ceil(F.col("size") * threshold - F.lit(1e-9)).cast("int")))


def _words_and_breaks(text: str) -> tuple[Column, Column]:
    """Words of a text, and how many of them stand before each line break that words stand around."""
    lowered = F.regexp_replace(F.translate(text, _UPPER, _LOWER), "\n", " \n ")
    tokens = F.array_remove(F.split(lowered, _BREAK_IN_LINE), "")
    places = F.filter(F.transform(tokens, lambda t, i: F.when(t == "\n", i)), lambda i: i.isNotNull())
    before = F.array_distinct(F.transform(places, lambda i, k: i - k))
    words = F.array_remove(tokens, "\n")
    return words, F.filter(before, lambda n: n > 0)


def wrapped_blocks(docs: DataFrame, vocabulary: Column, longest: int) -> DataFrame:
    """(node, words): the ``longest`` words on each side of each line break, of those in ``vocabulary``."""
    words, breaks = _words_and_breaks("text")
    split = docs.filter(F.contains("text", F.lit("\n"))).select(
        text_key("text").alias("node"), words.alias("words"), breaks.alias("breaks"))
    start = lambda n: F.greatest(n - longest, F.lit(0))
    around = F.transform("breaks", lambda n: F.array_intersect(
        F.slice("words", start(n) + 1, n - start(n) + longest), vocabulary))
    return split.select("node", F.explode(around).alias("words"))


def template_links(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                   threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """(node, label, containment): each distinct text's best block for each label that reaches the
    threshold. ``node`` is ``text_key(text)``; null texts have no blocks."""
    spark = docs.sparkSession
    rows = template_rows(spark, templates, threshold)
    known = rows.select(F.explode("words").alias("word")).distinct()
    least = min((r["need"] for r in rows.select("need").collect()), default=None)  # one per template
    if least is None:
        return docs.select(text_key("text").alias("node"), F.lit("").alias("label"),
                           F.lit(0.0).alias("containment")).limit(0)
    vocabulary = F.array(*[F.lit(r["word"]) for r in known.orderBy("word").collect()])
    blocks = (docs.filter("text IS NOT NULL")
              .select(text_key("text").alias("node"), F.explode(F.split("text", "\n")).alias("line"))
              .select("node", F.array_intersect(words_of("line"), vocabulary).alias("words")))
    if wrapped:
        blocks = blocks.unionByName(wrapped_blocks(docs, vocabulary, rows.agg(F.max("length")).first()[0]))
    blocks = (blocks.filter(F.size("words") >= least).distinct()
              .withColumn("block", F.xxhash64("words")))
    blocks = stored(blocks, "blocks")
    counted = (blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("blocks")))
    order = stored(known.join(counted, "word", "left")
                   .select("word", F.coalesce("blocks", F.lit(0)).alias("blocks")), "order")
    rank = F.broadcast(order)  # one row per word of a template

    def ordered(frame: DataFrame, *keys: str) -> DataFrame:
        cells = F.sort_array(F.collect_set(F.struct("blocks", "word")))
        return (frame.select(*keys, F.explode("words").alias("word")).join(rank, "word")
                .groupBy(*keys).agg(F.transform(cells, lambda c: c["word"]).alias("words")))

    own = ordered(rows, "template", "label", "size", "need")
    prefix = own.select("template", "label", "size", "need", F.col("words").alias("wanted"), F.posexplode(
        F.slice("words", F.lit(1), F.col("size") - F.col("need") + 1)).alias("i", "word"))
    # Many blocks are equal as sets; each set is joined once and its texts come back afterwards.
    sets = stored(ordered(blocks.dropDuplicates(["block"]), "block"), "sets")
    probes = sets.select("block", F.size("words").alias("have"), F.posexplode("words").alias("j", "word"))
    bound = 1 + F.least(F.col("size") - F.col("i") - 1, F.col("have") - F.col("j") - 1)
    # At the first common word of both orders the bound holds for the whole overlap.
    met = (probes.join(F.broadcast(prefix), "word").filter(F.col("have") >= F.col("need"))
           .groupBy("block", "template", "label", "size", "need", "wanted")
           .agg(F.min("i").alias("i"), F.min("j").alias("j"), F.first("have").alias("have"))
           .filter(bound >= F.col("need")))
    exact = (met.join(sets.select("block", "words"), "block")
             .withColumn("common", F.size(F.array_intersect("words", "wanted")))
             .filter(F.col("common") >= F.col("need"))
             .groupBy("block", "label").agg(F.max(F.col("common") / F.col("size")).alias("containment")))
    found = blocks.select("node", "block").join(sized(exact, exact.count(), 64), "block")
    return found.groupBy("node", "label").agg(F.max("containment").alias("containment"))


def _phrase_places(words: Column, phrases: tuple[tuple[str, str], ...]) -> Column:
    """Array of (start, size, label) of all places of all phrases."""
    def places(parts: list[str], label: str) -> Column:
        last = F.size(words) - len(parts)
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        holds = F.filter(starts, lambda i: functools.reduce(
            lambda a, b: a & b, [F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts)]))
        return F.transform(holds, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.flatten(F.array(*[places(phrase.split(" "), label) for phrase, label in phrases]))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD,
         phrases: tuple[tuple[str, str], ...] = PHRASES, wrapped: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``n_base`` counts all places of all phrases; the score is 1 with a phrase, else the largest
    containment that reached the threshold, else 0. Null texts have no words; a text without labels
    has empty label strings. Only with ``wrapped`` are notices found whose words lie on several lines
    with too few on each, which ``oracle`` does not know. Rows may repeat; an empty table gives no rows; other columns are not read.
    """
    links = template_links(docs, templates, threshold, wrapped)
    of_text = links.groupBy("node").agg(F.sort_array(F.collect_set("label")).alias("more"),
                                        F.max("containment").alias("containment"))
    of_text = stored(of_text, "labels")
    split = docs.select("doc_id", "text", text_key("text").alias("node"), words_of("text").alias("words"))
    # Places are searched only in texts with the last word of some phrase.
    lowered = F.translate("text", _UPPER, _LOWER)
    likely = F.lit(False)
    for ending in sorted({p.split(" ")[-1] for p, _ in phrases}):
        likely = likely | F.coalesce(F.contains(lowered, F.lit(ending)), F.lit(False))
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    places = F.when(likely, _phrase_places(F.col("words"), phrases)).otherwise(none)
    based = split.select("doc_id", "node", F.size("words").cast("long").alias("n_words"), places.alias("places"))
    based = based.join(sized(of_text, of_text.count(), 160), "node", "left")
    starts = F.transform("places", lambda p: p["start"])
    base = F.sort_array(F.array_distinct(F.transform("places", lambda p: p["label"])))
    both = F.sort_array(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    return based.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))


def oracle(templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD,
           phrases: tuple[tuple[str, str], ...] = PHRASES) -> str:
    """The same rows in DuckDB SQL, each block held against each template."""
    lowered = f"translate(coalesce({{}}, ''), '{_UPPER}', '{_LOWER}')"
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all({lowered}, '{pattern}')"
    wanted = ", ".join(f"('{t.label}', '{t.text}')" for t in templates)
    places = []
    for phrase, label in phrases:
        parts = phrase.split(" ")
        same = " AND ".join(f"words[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(f"[{{'start': i, 'label': '{label}'}} FOR i IN range(len(words) - {len(parts) - 1}) IF {same}]")
    return f"""
WITH templates AS (
  SELECT label, list_distinct({words.format('t')}) AS wanted FROM (VALUES {wanted}) AS v(label, t)
  WHERE len({words.format('t')}) > 0),
docs AS (SELECT row_number() OVER () AS n, doc_id, text, {words.format('text')} AS words FROM documents),
placed AS (SELECT *, {' || '.join(places)} AS places FROM docs),
blocks AS (SELECT n, list_distinct({words.format('line')}) AS held
           FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM docs)),
links AS (
  SELECT n, label, max(len(list_intersect(held, wanted)) / len(wanted)) AS containment
  FROM blocks, templates
  WHERE len(list_intersect(held, wanted)) >= ceil(len(wanted) * {threshold} - 1e-9) GROUP BY n, label),
more AS (SELECT n, list(label) AS labels, max(containment) AS containment FROM links GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
  list_min([p.start FOR p IN places])::BIGINT AS first_word, list_max([p.start FOR p IN places])::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct([p.label FOR p IN places])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([p.label FOR p IN places] || coalesce(more.labels, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0)::DOUBLE END AS score
FROM placed LEFT JOIN more USING (n)"""
