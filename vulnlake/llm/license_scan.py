"""License scan by diagonal voting.

Every rolling k-gram of words of every text is hashed and joined to the positions of the same k-gram in the license
templates. A hit votes for the diagonal ``text position - template position``; votes are aggregated by text, template
and diagonal. Where a text follows a template with a few words put in, left out or replaced, its votes lie on
neighbouring diagonals; these are merged into one span. A span is verified word by word: of the template's words at most ``GRAM``
per allowed edit are missing (so many an edit near an end takes out of all k-grams), at most one per allowed edit is foreign, and the words that tell one license from another
(``FAMILY`` words and numbers) are those of the template, no more and no fewer. An edit is allowed for every
``WORDS_PER_EDIT`` words of a template, and at least one.
A phrase that must match word for word is a template whose diagonal has all its votes; the diagonal is its start.

The telling words of a text are summed up as it is read: every k-gram bears the sums before and after it, so a span knows
which it holds without another look at the text.

Templates are a parameter. Their positions are broadcast up to ``BROADCAST_GRAMS`` rows; beyond that the join is left
to Spark.

Edge cases: null and empty texts have no words and no labels; texts shorter than a k-gram have none either; repeated
rows are scanned one by one; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnlake.llm import common as C

GRAM = 3
BROADCAST_GRAMS = 200_000
NEAR = 3
WORDS_PER_EDIT = 12
#: Bytes of text handled at once in a task, but for one longer text: a k-gram with its sums takes 24.
CHUNK = 1 << 20

WORD_BYTES = bytes([*range(48, 58), *range(97, 123), *range(128, 256)])
DIGITS = bytes(range(48, 58))
#: Sums of telling words stay far below 2^63 for texts of any length.
MARK_BITS = 36

# The phrases of the base scan, and passages of public licenses and of the notices that name them.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
TEMPLATES = [
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("lgpl-3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 3.0 Unported License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-sa", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-nd", "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
]
#: Words that tell families of licenses, and licenses of one family, apart; words of digits alone count as well.
FAMILY = ["affero", "apache", "commons", "gnu", "lesser", "library", "mozilla", "noncommercial", "noderivatives", "noderivs", "sharealike"]


def _run_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = C.runs(data != 32, np.array([0, len(data)]))
    return C.run_hashes(data, starts, ends)


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the text of each, and what each adds to the sum of telling words (0 for most)."""
    data = C.lower_ascii()[data]
    starts, ends, owner = C.runs(C.table_of(WORD_BYTES)[data], at)
    hashes = C.run_hashes(data, starts, ends)
    letters = np.concatenate([[0], np.cumsum(~C.table_of(DIGITS)[data], dtype=np.int64)])
    telling = (letters[ends] == letters[starts]) | np.isin(hashes, _run_hashes(FAMILY))
    return hashes, owner, np.where(telling, hashes >> np.uint64(64 - MARK_BITS) | np.uint64(1), np.uint64(0)).astype(np.int64)


def _sums(marks: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[place], total[place + size]


def grams(df: DataFrame, key: str, text: str, size: int = GRAM) -> DataFrame:
    """Per text: a row number, the key, the number of words, and every k-gram in order: its hash, and the sums of telling words before and after it."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text, CHUNK):
                words, owner, marks = _words(data, at)
                hashes, place = C.windows(words, owner, size)
                before, after = _sums(marks, place, size)
                n = end - first
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[place], minlength=n))]).astype(np.int32)
                rolled = pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array(before), pa.array(after)], ["gram", "before", "after"])
                columns = [
                    batch.column("_row").slice(first, n),
                    batch.column(key).slice(first, n),
                    pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), rolled),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_row", key, "n_words", "grams"])

    kind = dict(df.dtypes)[key]
    rows = df.select(F.monotonically_increasing_id().alias("_row"), key, text)
    return rows.mapInArrow(batches, f"_row bigint, `{key}` {kind}, n_words bigint, grams array<struct<gram: bigint, before: bigint, after: bigint>>")


def positions(spark: SparkSession, templates: list[tuple[str, str]], exact: list[tuple[str, str]], size: int = GRAM) -> DataFrame:
    """Every k-gram of every template: its hash and place, the template, its label, words and telling sum, and whether it is a phrase."""
    rows = []
    for n, (label, text) in enumerate([*exact, *templates]):
        raw = np.frombuffer(text.encode(), np.uint8)
        words, owner, marks = _words(raw, np.array([0, len(raw)]))
        hashes, _ = C.windows(words, owner, size)
        if not len(hashes):
            raise ValueError(f"shorter than {size} words: {text!r}")
        rows += [(int(h), n, k, label, len(words), int(marks.sum()), n < len(exact)) for k, h in enumerate(hashes.view(np.int64))]
    table = spark.createDataFrame(rows, "gram bigint, template int, place int, label string, size int, telling bigint, phrase boolean")
    return F.broadcast(table) if len(rows) <= BROADCAST_GRAMS else table


def _covered(starts: str) -> str:
    """Distinct words under the k-grams that start at these places."""
    return f"size(array_distinct(flatten(transform({starts}, p -> sequence(p, p + {GRAM - 1})))))"


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """Per text: key, ``n_words``, places of phrases (number, first, last, labels), all labels, best coverage, and spans."""
    template = positions(df.sparkSession, templates, phrases)
    own = ["template", "label", "size", "telling", "phrase"]
    rolled = grams(df, key, text).select("_row", key, "n_words", F.posexplode_outer("grams").alias("pos", "g")).select("_row", key, "n_words", "pos", "g.*")
    voted = (
        rolled.join(template, "gram", "left")
        .groupBy("_row", key, "n_words", *own, (F.col("pos") - F.col("place")).alias("diagonal"))
        .agg(F.collect_list("place").alias("places"), F.min("before").alias("before"), F.max("after").alias("after"))
    )
    along = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    moved = F.transform("places", lambda p: p + F.col("diagonal"))
    spans = (
        voted.withColumn("new", F.coalesce((apart > NEAR) | F.col("phrase"), F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("moved", moved)
        .groupBy("_row", key, "n_words", *own, "span")
        .agg(
            F.flatten(F.collect_list("places")).alias("places"), F.flatten(F.collect_list("moved")).alias("moved"),
            F.min("before").alias("before"), F.max("after").alias("after"),
        )
    )
    covered = F.expr(_covered("places"))
    first, last = F.array_min("moved"), F.array_max("moved") + GRAM
    foreign = last - first - F.expr(_covered("moved"))
    edits = F.greatest(F.lit(1), F.floor(F.col("size") / WORDS_PER_EDIT))
    same = F.col("after") - F.col("before") == F.col("telling")
    verified = (F.col("size") - covered <= GRAM * edits) & (foreign <= edits) & same
    found = F.when(F.col("phrase"), F.size("places") == F.col("size") - (GRAM - 1)).otherwise(verified)
    base, start = F.coalesce(F.col("phrase") & found, F.lit(False)), first.cast("long")
    judged = spans.withColumns({"found": F.coalesce(found, F.lit(False)), "base": base, "coverage": covered / F.col("size"), "first": start})
    joined = lambda flag: F.array_join(F.array_sort(F.collect_set(F.when(F.col(flag), F.col("label")))), ",")
    return judged.groupBy("_row", key, "n_words").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("found").alias("labels"),
        F.coalesce(F.max(F.when(F.col("found"), F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.count_if("found").alias("n_spans"),
    ).drop("_row")
