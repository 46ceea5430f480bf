"""License scan: phrases by place, and an exact set-similarity join of text blocks with license notices.

Everything is DataFrame and SQL functions. A block is a line of the text, as the set of its
words. It holds a notice if it holds at least the threshold share of the notice's words.
Words of the notices are put in one global order, rarest in the corpus first. A block that
meets the threshold shares with the notice at least one word of its prefix, the first
``n - need + 1`` words in that order; the length filter asks for ``need`` words, and the
positional filter drops pairs whose words left after the match can't reach ``need``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import stage

THRESHOLD = 0.8
#: Bytes that end a word, after lower-casing.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word in the text as it stands.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Common license notices, by the label that the join gives.
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at"
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met"
    ),
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction"
    ),
}


def words_of(text: str) -> list[str]:
    """Distinct words of a notice."""
    return sorted(set(re.sub(BREAK, " ", text.lower()).split()))


def need_of(words: list[str], threshold: float) -> int:
    """Words that a block must share; rounded first, so that 0.8 of 5 is 4."""
    return max(1, math.ceil(round(threshold * len(words), 9)))


def _literal(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def _starts(words: Column, parts: list[str], label: str) -> Column:
    """(start, label) of every place where ``parts`` stand in ``words``."""

    def fits(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + k) == part)
        return same

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), fits)
    return F.transform(starts, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))


_NO_PLACES = "array<struct<start:bigint,label:string>>"


def _places(lowered: Column, phrases: Mapping[str, str]) -> Column:
    """(start, label) of every place where the words of a phrase stand one after the other."""
    if not phrases:
        return F.lit(None).cast(_NO_PLACES)

    def of(words: Column) -> Column:
        return F.concat(*(_starts(words, phrase.split(), label) for phrase, label in phrases.items()))

    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    last_words = sorted({p.split()[-1] for p in phrases})
    holds = F.lit(False)
    for word in last_words:
        holds = holds | F.contains(lowered, F.lit(word))
    # inside transform the words are a variable and so are made once per text
    return F.when(holds, F.get(F.transform(F.array(words), of), F.lit(0)))


def scan(
    docs: DataFrame,
    notices: Mapping[str, str] = NOTICES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score``.

    Base columns come from the phrases: number of places, smallest and largest word position
    of a start (null if none). ``labels`` adds the notices that a line of the text holds, and
    ``score`` is the largest share of a held notice, 1 where a phrase stands, else 0. Lists
    are distinct, sorted and comma-joined; none gives the empty text. Null text counts as
    empty. Repeated rows and null ids are kept, other columns are not read; empty table: no rows.
    """
    sets = {label: words_of(text) for label, text in notices.items()}
    needs = {label: need_of(words, threshold) for label, words in sets.items()}
    vocabulary = sorted(set().union(*sets.values())) if sets else []
    least = min(needs.values(), default=1)
    text = F.coalesce("text", F.lit(""))
    lowered = F.lower(text)
    blocks = F.filter(
        F.transform(F.split(lowered, "\n"), lambda line: F.array_intersect(F.split(line, BREAK), _literal(vocabulary))),
        lambda shared: F.size(shared) >= least,
    )
    rows = stage(
        docs.select("doc_id", text.alias("text")).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
            _places(lowered, phrases).alias("places"),
            blocks.alias("blocks"),
        ),
        "license-blocks",
    )
    held = _held(rows, sets, needs, vocabulary)
    places = F.coalesce("places", F.array().cast(_NO_PLACES))
    base = F.transform(places, lambda p: p["label"])
    starts = F.transform(places, lambda p: p["start"])
    own = F.coalesce("found", F.array().cast("array<string>"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return rows.join(held, "row", "left").select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _held(rows: DataFrame, sets: dict[str, list[str]], needs: dict[str, int], vocabulary: list[str]) -> DataFrame:
    """(``row``, ``found`` labels, largest ``share``) of the rows with a block that holds a notice."""
    spark = rows.sparkSession
    blocks = rows.select("row", F.explode("blocks").alias("shared")).select("row", "shared")
    # one count per word of the notices
    seen = dict(map(tuple, blocks.select(F.explode("shared").alias("word")).groupBy("word").count().collect()))
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    prefixes = []
    for label, words in sets.items():
        ranked = sorted(words, key=order.index)
        need = needs[label]
        prefixes += [(w, label, ranked, need, p) for p, w in enumerate(ranked[: len(ranked) - need + 1])]
    index = spark.createDataFrame(prefixes, "word string, label string, notice array<string>, need int, at int")
    ordered = blocks.select("row", F.array_intersect(_literal(order), F.col("shared")).alias("shared"))
    matches = ordered.select("row", "shared", F.posexplode("shared").alias("place", "word")).join(F.broadcast(index), "word")
    left = F.least(F.size("shared") - F.col("place"), F.size("notice") - F.col("at"))
    candidates = matches.where(F.size("shared") >= F.col("need")).where(left >= F.col("need"))
    overlap = F.size(F.array_intersect("notice", "shared"))
    checked = candidates.select("row", "label", "need", overlap.alias("overlap"), F.size("notice").alias("n")).where("overlap >= need")
    return checked.groupBy("row").agg(F.collect_set("label").alias("found"), F.max(F.col("overlap") / F.col("n")).alias("share"))
