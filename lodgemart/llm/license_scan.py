"""License scans by diagonal voting.

Every rolling window of ``GRAM`` words of every text is hashed and joined with the windows
of the license templates. A hit votes for the diagonal (place in the text minus place in the
template); neighbouring diagonals of one template are merged, so a few words put in or left
out do not break a match; a merged span is verified by the share of the template's words that
its windows cover, in a span not much longer than the template. Built-in expressions only.

Beside it, ``PHRASES`` are counted wherever their words stand consecutively.

Defined cases: a null text has no words; a null id is carried through; rows equal in id and
text get equal results, one for each; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgemart.llm.common import row_key, size_checked, words_of

GRAM = 4
NEIGHBOUR = 3
COVERED = 0.8
STRETCH = 1.3
#: Template windows that may be sent to all tasks; more are joined by shuffling.
BROADCAST_WINDOWS = 200_000

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licenses word them.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}


def gram_hashes(words: Column) -> Column:
    """One hash for each window of ``GRAM`` words."""

    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)])

    n = F.size(words) - GRAM
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), at)).otherwise(F.array().cast("array<bigint>"))


def template_windows(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """(hash, template, label, n_template, t_at) of all template windows."""
    rows = [(f"{label}/{k}", label, t) for label, texts in templates.items() for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "template string, label string, text string")
    frame = frame.withColumn("words", words_of(F.col("text"))).withColumn("n_template", F.size("words"))
    return frame.select(
        "template", "label", "n_template", F.posexplode(gram_hashes(F.col("words"))).alias("t_at", "hash")
    )


def places_of(words: Column, phrase: str, label: str) -> Column:
    """(at, label) of every place of one phrase, found from its last word on."""
    *head, last = phrase.split(" ")
    before = len(head)

    def whole(i: Column) -> Column:
        same = [F.get(words, i - before + k) == w for k, w in enumerate(head)]
        return reduce(Column.__and__, same, i >= before)

    ends = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == last)
    return F.transform(
        F.filter(ends, whole), lambda i: F.struct((i - before).alias("at"), F.lit(label).alias("label"))
    )


def phrase_places(words: Column) -> Column:
    """(at, label) of every place of any phrase."""
    last_words = {p.split(" ")[-1] for p in PHRASES}
    some = reduce(Column.__or__, [F.array_contains(words, w) for w in last_words])
    none = F.array().cast("array<struct<at:int,label:string>>")
    return F.when(some, F.concat(*[places_of(words, p, x) for p, x in PHRASES.items()])).otherwise(none)


def verified_spans(
    docs: DataFrame, templates: dict[str, tuple[str, ...]], id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Spans (k1, k2, template, label, first_word, last_word, share) that passed, by row key."""
    windows = size_checked(template_windows(docs.sparkSession, templates), BROADCAST_WINDOWS)
    # A column of its own: within the expression of a window, the words would be cut anew for each.
    worded = docs.select(*row_key(id_col, text), words_of(F.col(text)).alias("words"))
    grams = worded.select("k1", "k2", F.posexplode(gram_hashes(F.col("words"))).alias("at", "hash"))
    hits = grams.join(windows, "hash").select(
        "k1", "k2", "template", "label", "n_template", "t_at", "at", (F.col("at") - F.col("t_at")).alias("diagonal")
    )
    by = ["k1", "k2", "template"]
    # One vote for each window of the template on a diagonal: a row there is bounded by the template.
    votes = hits.groupBy(*by, "label", "n_template", "diagonal").agg(
        F.collect_set("t_at").alias("t_ats"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    along = Window.partitionBy(*by).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOUR, F.lit(True))
    group = F.sum(F.when(F.col("apart"), 1).otherwise(0)).over(along)
    merged = (
        votes.withColumn("apart", apart)
        .withColumn("span", group)
        .groupBy(*by, "label", "n_template", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("t_ats"))).alias("t_ats"),
            F.min("first").alias("first_word"),
            (F.max("last") + GRAM - 1).alias("last_word"),
        )
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("t_ats", lambda t: F.sequence(t, t + GRAM - 1))))
    )
    length = F.col("last_word") - F.col("first_word") + 1
    return (
        merged.withColumn("share", covered / F.col("n_template"))
        .where((F.col("share") >= COVERED) & (length <= F.greatest(F.col("n_template") * STRETCH, F.col("n_template") + 2.0)))
        .drop("t_ats", "span", "n_template")
    )


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row: words, phrase places, labels of phrases and of both, and a score.

    The score is the largest covered share of a verified template, 0.5 for a phrase alone.
    """
    found = (
        verified_spans(docs, templates or TEMPLATES, id_col, text)
        .groupBy("k1", "k2")
        .agg(F.collect_set("label").alias("spans"), F.max("share").alias("share"))
    )
    worded = docs.select(
        F.col(id_col).alias("id"), *row_key(id_col, text), words_of(F.col(text)).alias("words")
    )
    rows = worded.select(
        "id",
        "k1",
        "k2",
        F.size("words").cast("long").alias("n_words"),
        phrase_places(F.col("words")).alias("places"),
    )
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    at = F.transform("places", lambda p: p["at"])
    none = F.array().cast("array<string>")
    return rows.join(found, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("spans", none))), ",").alias("labels"),
        F.greatest(
            F.coalesce("share", F.lit(0.0)), F.when(F.size("places") > 0, 0.5).otherwise(0.0)
        ).alias("score"),
    )
