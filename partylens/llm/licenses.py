"""License notices in texts, by votes of word runs for offset diagonals.

All rolling runs of ``GRAM`` words of all texts are joined with the runs of the templates. A match of text place i
with template place j votes for the diagonal i - j: the place where the template would begin. Votes are gathered by
text, template and diagonal; neighbouring diagonals are one span, since an added or missing word moves the rest of a
notice to the next diagonal. A run votes only if its words are the template's, so a span is verified by its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partylens.llm.texts import LOWER, mixed, pieces, prefix_sums, span_hashes, words

GRAM = 3  # words of a voting run, and the fewest words of a template
DRIFT = 10  # one word of drift between neighbouring diagonals for so many words of a notice
LEAST = 0.95  # share of a template's words that gives its label
SHOWN = 0.5  # share from which a span is reported
BLOCK = 1 << 18  # template runs that are broadcast at once; more are joined in turn

SPACE = np.ones(256, bool)
SPACE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
SPACE_OR_UPPER = SPACE.copy()  # the same before A-Z are lower-cased
SPACE_OR_UPPER[range(0x41, 0x5B)] = False


@dataclass(frozen=True)
class Template:
    """A phrase is found where its words stand one after another; a notice may have changes."""

    label: str
    text: str
    phrase: bool = False

    def words(self) -> list[bytes]:
        data = LOWER[np.frombuffer(self.text.encode(), np.uint8)]
        starts, ends, _ = words(data, np.array([0, len(data)]), SPACE)
        return [data[a:z].tobytes() for a, z in zip(starts, ends)]

    def drift(self) -> int:
        return 0 if self.phrase else len(self.words()) // DRIFT


# Phrases and the notices in common use.
PHRASES = [
    Template("mit", "under the MIT license", True),
    Template("apache-2", "Apache License, Version 2", True),
    Template("cc-by-nc", "CC BY-NC", True),
]
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    Template("gpl-3", "under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _grams(word: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    run = np.zeros(len(at), np.uint64)
    for k in range(gram):
        run = mixed(run * np.uint64(0x9E3779B97F4A7C15) + word[at + k])
    return run.view(np.int64)


def _hashed(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``gram`` words inside a text, and the number of them per text."""
    data = LOWER[data]
    starts, ends, n = words(data, offsets, SPACE)
    word = span_hashes(prefix_sums(data), starts, ends)
    ends_at = np.repeat(np.cumsum(n), n)
    at = np.flatnonzero(np.arange(len(starts)) + gram <= ends_at)
    return _grams(word, at, gram), np.maximum(n - gram + 1, 0)


def _rolling(gram: int):
    """Per text the hash of each run of words, and where each word begins and ends."""
    def rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "_text"):
            starts, ends, n = words(data, offsets, SPACE_OR_UPPER)
            value, runs = _hashed(data, offsets, gram)
            bounds = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            begin = np.repeat(offsets[:-1], n)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("_key")), batch.column(batch.schema.get_field_index("_text")).cast(pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(runs)]).astype(np.int32)), pa.array(value)),
                pa.ListArray.from_arrays(bounds, pa.array((starts - begin).astype(np.int32))),
                pa.ListArray.from_arrays(bounds, pa.array((ends - begin).astype(np.int32))),
            ], names=["_key", "_text", "hashes", "starts", "ends"])

    return rolling


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in pieces(batches, "_text"):
        n = words(data, offsets, SPACE_OR_UPPER)[2]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(batch.schema.get_field_index("_key")), pa.array(n.astype(np.int64))], names=["_id", "_key", "n_words"])


def _places(templates: list[Template], gram: int) -> list[tuple[int, str, int, int]]:
    """(hash, words, template, place) of every run of the templates."""
    rows = []
    for number, template in enumerate(templates):
        text = b" ".join(template.words())
        if len(template.words()) < gram:
            raise ValueError(f"a template needs {gram} words: {template.text!r}")
        value, _ = _hashed(np.frombuffer(text, np.uint8), np.array([0, len(text)]), gram)
        rows.extend((int(v), b" ".join(template.words()[j:j + gram]).decode(), number, j) for j, v in enumerate(value))
    return rows


def license_spans(
    docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text",
    gram: int = GRAM, shown: float = SHOWN, block: int = BLOCK,
) -> DataFrame:
    """The spans of each text that agree with a template: ``(id_col, n_words, spans)``.

    A-Z are lower-cased; words are runs of 0-9, a-z and characters from U+0080. A span's score is the number of template
    words that stand in matched runs, by the words of the template or, if that is more, of the span. ``spans`` has every
    place where a phrase stands word by word, and the notices with a score of ``shown`` or more, by first word and template.

    The templates are a list, so they are small; they are broadcast ``block`` runs at a time, each block one more pass.
    No text is shuffled: a match is compared word by word where the text lies, and only matches go on, gathered by text,
    template and diagonal before. A text's matches are at most its words times the templates. Equal texts are
    one group whose matches are counted once; ids and numbers of words are joined with the spans by the texts' digest.

    A null text has no words and no spans; a null id stays null; every row gives a row of its own, repeated ids and rows
    too; other columns are ignored, whatever their names; an empty table gives an empty one. A text is handled as a whole,
    at some 50 bytes of memory a byte.
    """
    spark = docs.sparkSession
    templates = PHRASES + NOTICES if templates is None else templates
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_key", F.md5(F.col("_text").cast("binary")))
    grams = rows.select("_key", "_text").mapInArrow(_rolling(gram), "_key string, _text binary, hashes array<bigint>, starts array<int>, ends array<int>")
    grams = grams.select("_key", "_text", "starts", "ends", F.posexplode("hashes").alias("i", "hash"))
    at, to = F.get("starts", F.col("i")), F.get("ends", F.col("i") + (gram - 1))
    said = F.translate(F.substring("_text", at + 1, to - at).cast("string"), ascii_uppercase, ascii_lowercase)
    said = F.regexp_replace(said, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")

    places = _places(templates, gram)
    votes = None
    for first in range(0, max(len(places), 1), block):
        part = spark.createDataFrame(places[first:first + block], "hash bigint, words string, template int, j int")
        # Written as a range, so that it is no join key, which would be computed for runs without a match too.
        hits = grams.join(F.broadcast(part), "hash").where(said.between(F.col("words"), F.col("words")))
        hits = hits.select("_key", "template", (F.col("i") - F.col("j")).cast("bigint").alias("diagonal"), "j")
        votes = hits if votes is None else votes.unionByName(hits)
    diagonals = votes.groupBy("_key", "template", "diagonal").agg(F.collect_set("j").alias("js"))

    facts = spark.createDataFrame(
        [(i, t.label, t.phrase, len(t.words()), t.drift()) for i, t in enumerate(templates)], "template int, label string, phrase boolean, size int, drift int")
    in_order = Window.partitionBy("_key", "template").orderBy("diagonal")
    diagonals = diagonals.join(F.broadcast(facts), "template")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_order)
    diagonals = diagonals.withColumn("_new", F.when(gap <= F.col("drift"), 0).otherwise(1)).withColumn("_span", F.sum("_new").over(in_order))
    begin, end = F.min(F.col("diagonal") + F.array_min("js")), F.max(F.col("diagonal") + F.array_max("js")) + gram
    matched = F.flatten(F.collect_list(F.flatten(F.transform("js", lambda j: F.sequence(j, j + (gram - 1))))))
    spans = diagonals.groupBy("_key", "template", "label", "phrase", "size", "_span").agg(
        begin.alias("first_word"), (end - begin).alias("n_words"), F.array_size(F.array_distinct(matched)).alias("_covered"))
    spans = spans.withColumn("score", F.col("_covered") / F.greatest("size", "n_words"))
    spans = spans.where(F.when(F.col("phrase"), F.col("score") >= 1).otherwise(F.col("score") >= shown))
    listed = F.array_sort(F.collect_list(F.struct("first_word", "template", "label", "phrase", "n_words", "score")))
    spans = spans.groupBy(F.col("_key").alias("_of")).agg(listed.alias("spans"))

    counted = rows.mapInArrow(_counted, f"_id {kind}, _key string, n_words bigint")
    found = counted.join(spans, F.col("_key") == F.col("_of"), "left")
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select(F.col("_id").alias(id_col), "n_words", F.coalesce("spans", none).alias("spans"))


def license_digest(found: DataFrame, id_col: str = "doc_id", least: float = LEAST) -> DataFrame:
    """A row per text: places of the phrases, labels of phrases and of notices with a score of ``least``, and the highest score."""
    base = F.filter("spans", lambda s: s["phrase"])
    first = F.transform(base, lambda s: s["first_word"])

    def listed(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        id_col, "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.filter("spans", lambda s: s["phrase"] | (s["score"] >= least))).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
