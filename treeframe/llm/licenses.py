"""License scan by diagonal voting.

The rolling hashes of every ``GRAM`` words of all texts are joined, in Spark,
with the places of the same hashes in license templates. A hit votes for a
diagonal: its place in the text minus its place in the template. Votes are
added up per text, template and diagonal; diagonals next to each other, as words
were left out or put in, merge; and a merged span is verified by the share of
the template's grams that it holds, each counted once, and by its length; of verified spans
that overlap, those that hold less of their template go (a text of version 3
also holds most of the notice of version 2). Phrases are templates of which every gram must lie on one diagonal: then their
words stand consecutively.

The templates are a constant of this module, a few thousand places, and are
broadcast. Hashes are made in the scan and never shuffled, only votes are.

Words are runs of digits, a-z (A-Z in lower case) and characters beyond ASCII.
Defined results: a null or empty text has no words and no labels and scores 0;
rows that repeat an id are rows of their own; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, text_of
from treeframe.llm.words import LETTERS, Words, rolling, slices

GRAM = 2
GAP = 3  # diagonals at most so far apart are one span
COVER = 0.7  # of a template's grams
LONGER = 1.5  # times the template's words that a span may have

# Phrases that are reported wherever they stand, and their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# License notices and their labels.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of
     this software and associated documentation files (the "Software"), to deal in the Software
     without restriction, including without limitation the rights to use, copy, modify, merge,
     publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
     to whom the Software is furnished to do so, subject to the following conditions"""),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not
     use this file except in compliance with the License. You may obtain a copy of the License
     at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it
     under the terms of the GNU General Public License as published by the Free Software
     Foundation, either version 3 of the License, or (at your option) any later version"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification,
     are permitted provided that the following conditions are met"""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License,
     v. 2.0"""),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
)


def _grams(text: str) -> tuple[list[int], int]:
    words = Words(pa.array([text]), LETTERS, lower=True)
    return rolling(words.hashes(), GRAM).view(np.int64).tolist(), len(words.starts)


def template_places(spark) -> DataFrame:
    """Every gram of every template: gram, template, place, label, phrase, n_grams, n_template."""
    rows = []
    for number, (label, text) in enumerate([*PHRASES, *TEMPLATES]):
        grams, n = _grams(text)
        rows += [
            (gram, number, place, label, number < len(PHRASES), len(grams), n)
            for place, gram in enumerate(grams)
        ]
    # Stands at the end of every text, so that texts without hits stay.
    rows.append((0, -1, 0, "", False, 1, 0))
    return spark.createDataFrame(
        rows, "gram long, template int, place int, label string, phrase boolean, "
        "n_grams int, n_template int",
    )


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column(1), LETTERS, lower=True)
            room = np.maximum(words.counts - GRAM + 1, 0)
            ends = np.cumsum(room + 1)
            values = np.zeros(ends[-1], np.int64)
            own = np.ones(len(values), bool)
            own[ends - 1] = False
            if own.any():
                whole = words.room()[: len(words.starts) - GRAM + 1] >= GRAM
                values[own] = rolling(words.hashes(), GRAM)[whole].view(np.int64)
            offsets = np.concatenate([[0], ends])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words.counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))],
                ["doc_id", "n_words", "grams"],
            )


def _listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: row, doc_id, n_words, spans.

    A span is (label, phrase, start, end, cover): words from ``start`` to before
    ``end``, and the share of the template that it holds.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    grams = (
        map_batches(rows, _text_grams, "doc_id bigint, n_words bigint, grams array<bigint>")
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "n_words", F.posexplode("grams").alias("pos", "gram"))
    )
    hits = grams.join(F.broadcast(template_places(docs.sparkSession)), "gram")
    text_key = ["row", "doc_id", "n_words"]
    key = [*text_key, "template", "label", "phrase", "n_grams", "n_template"]
    diagonals = hits.groupBy(*key, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"),
        F.min("pos").alias("first"), F.max("pos").alias("last"),
    )
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    apart = F.when(F.col("phrase") | step.isNull() | (step > GAP), 1).otherwise(0)
    merged = (
        diagonals.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(by_diagonal))
        .groupBy(*key, "span")
        .agg(
            (F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.first("n_grams"))
            .alias("cover"),
            F.min("first").cast("bigint").alias("start"),
            (F.max("last") + GRAM).cast("bigint").alias("end"),
        )
    )
    length = F.col("end") - F.col("start")
    verified = (F.col("template") >= 0) & F.when(F.col("phrase"), F.col("cover") == 1).otherwise(
        (F.col("cover") >= COVER) & (length <= F.col("n_template") * LONGER + GAP)
    )
    spans = merged.groupBy(*text_key).agg(
        F.collect_list(
            F.when(verified, F.struct("label", "phrase", "start", "end", "cover", "n_grams"))
        ).alias("spans")
    )

    def beaten(one: Column) -> Column:
        return ~one["phrase"] & F.exists(
            "spans",
            lambda s: ~s["phrase"] & (s["start"] < one["end"]) & (one["start"] < s["end"])
            & (F.struct(s["cover"], s["n_grams"]) > F.struct(one["cover"], one["n_grams"])),
        )

    return spans.withColumn("spans", F.filter("spans", lambda s: ~beaten(s)))


def license_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])
    return license_spans(docs, id, text).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _listed(F.transform(base, lambda s: s["label"])).alias("base_labels"),
        _listed(F.transform(spans, lambda s: s["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["cover"])), F.lit(0.0))
        .alias("score"),
    )
