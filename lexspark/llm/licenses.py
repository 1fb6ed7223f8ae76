"""License scans: word k-grams of documents vote for diagonals of license templates.

Every k-gram of every text is joined, by its hash, to the places it has in the templates. A hit at
word ``p`` of a text and word ``q`` of a template votes for the diagonal ``p - q``, the word where
the template would begin. A phrase has to stand whole on one diagonal. For a notice the diagonals a
few words around are merged, which are those of a copy with words put in or left out, and the words
of the template that the merged diagonals cover decide.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm.common import lower_ascii, text_or_empty

#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words put in or left out up to which diagonals are merged, and the share of a notice's words that have to be there.
REACH, SHARE = 3, 0.6
#: Words of a gram; shorter phrases have grams of two.
K = 3


@dataclass(frozen=True)
class Template:
    """A label and the text that speaks for it: a ``phrase`` counts whole only; ``base`` ones are asked for by themselves."""

    label: str
    text: str
    phrase: bool = False
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(GAP, self.text.lower()) if w]

    @property
    def k(self) -> int:
        return min(K, len(self.words))


# Phrases and labels that are asked for, and the notices their licenses tell authors to use.
TEMPLATES = (
    Template("gpl", "gnu general public license", True, True),
    Template("apache", "apache license", True, True),
    Template("cc-by", "cc by", True, True),
    Template("mit", "mit license", True, True),
    Template("lgpl", "gnu lesser general public license", True),
    Template("agpl", "gnu affero general public license", True),
    Template("mpl", "mozilla public license", True),
    Template("bsd", "bsd license", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("cc-by-nd", "cc by nd", True),
    Template("cc-by-sa", "cc by sa", True),
    Template("cc-by", "creative commons attribution", True),
    Template("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
             "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
             "furnished to do so, subject to the following conditions"),
    Template("apache-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
             "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
             "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
             "ANY KIND, either express or implied."),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
             "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
             "following disclaimer."),
    Template("isc-notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies."),
    Template("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


def _places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``gram_hash, gram, template, at`` for every gram of every template, and the empty gram, of template -1.

    As many rows as the templates have words, whatever the corpus: this bounds the broadcast.
    """
    rows = [("", -1, 0)]
    for number, template in enumerate(templates):
        rows += [(" ".join(template.words[i:i + template.k]), number, i) for i in range(len(template.words) - template.k + 1)]
    made = spark.createDataFrame(rows, "gram string, template int, at int")
    return made.select(F.xxhash64("gram").alias("gram_hash"), "gram", "template", "at")


def _facts(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = [(n, t.label, t.phrase, t.base, t.k, len(t.words)) for n, t in enumerate(templates)] + [(-1, None, None, None, 1, 1)]
    return spark.createDataFrame(rows, "template int, label string, phrase boolean, base boolean, k int, length int")


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), GAP), "")


def _grams(words: Column) -> Column:
    """The empty gram, then the grams of two words and those of three that begin at each word, null where the text ends before."""
    follow = lambda left, by: F.zip_with(left, F.slice(words, by, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    two = follow(words, 2)
    return F.concat(F.array(F.lit("")), two, follow(two, 3))


def votes(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row, doc_id, n_words, template, diagonal, hits, copies``: the places of each template that vote for a diagonal of a row.

    Each row has template -1 as well, so that none is lost. Rows equal in id and text are one, ``copies`` of it.
    """
    key = F.struct(F.xxhash64(F.col(id_column).cast("string"), text_column), F.xxhash64(text_column, F.col(id_column).cast("string"), F.lit(1)))
    rows = docs.select(F.col(id_column).alias("doc_id"), key.alias("row"), words(text_or_empty(text_column)).alias("words"))
    grams = rows.select("row", "doc_id", F.size("words").alias("n_words"), F.posexplode(_grams(F.col("words"))).alias("k", "gram"))
    hashed = grams.select("row", "doc_id", "n_words", "k", "gram", F.xxhash64("gram").alias("gram_hash"))
    hits = hashed.join(F.broadcast(_places(docs.sparkSession, templates)), ["gram_hash", "gram"])
    # Grams of two and of three words come one list after the other, as many of either as there are words.
    place = F.when(F.col("template") < 0, 0).otherwise(F.pmod(F.col("k") - 1, F.greatest("n_words", F.lit(1))))
    found = hits.select("row", "doc_id", "n_words", "template", (place - F.col("at")).alias("diagonal"), "at")
    # Copies fold in each task first, so a row that fills a third of the corpus is shuffled once a task.
    folded = found.groupBy(*found.columns).agg(F.count("*").alias("copies"))
    return folded.repartition("row").groupBy("row", "doc_id", "n_words", "template", "diagonal").agg(F.collect_list("at").alias("hits"), F.max("copies").alias("copies"))


def _single(hits: Column, k: Column) -> Column:
    """The words of a template that its grams at these places cover."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda at: F.sequence(at, at + k - 1))))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text",
         reach: int = REACH, share: float = SHARE) -> DataFrame:
    """``doc_id, n_words, spans, score`` for every row; a span is ``label, base, start, covered, length``.

    A span begins at word ``start`` (from 0; before the text if the copy lacks its beginning) and covers
    ``covered`` of the ``length`` words of a template: all of a phrase's, which stand consecutively, or a share
    of ``share`` or more of a notice's on diagonals up to ``reach`` words apart; neighbouring beginnings of one
    notice are spans of their own. ``score`` is the highest share of a template found, spans or not. A null text
    counts as empty; a text without a hit has no spans and score 0. Rows equal in id and text stay rows of
    their own, whatever the id (null as well); other columns don't matter; no rows give no rows. Grams are
    compared as words, not by hash alone. A text is one cell whatever its length, and so are its spans.
    """
    found = votes(docs, templates, id_column, text_column).join(F.broadcast(_facts(docs.sparkSession, templates)), "template")
    own = Window.partitionBy("row", "template").orderBy("diagonal")
    around = F.when(F.col("phrase"), F.array("hits")).otherwise(F.collect_list("hits").over(own.rangeBetween(-reach, reach)))
    judged = found.withColumn("covered", F.size(_single(F.flatten(around), F.col("k"))))
    whole = F.when(F.col("phrase"), F.size("hits") == F.col("length") - F.col("k") + 1).otherwise(F.col("covered") >= share * F.col("length"))
    part = F.when(F.col("phrase") & ~whole, 0.0).when(F.col("template") >= 0, F.col("covered") / F.col("length"))
    span = F.struct("label", "base", F.col("diagonal").cast("long").alias("start"), F.col("covered").cast("long").alias("covered"), F.col("length").cast("long").alias("length"))
    rows = judged.groupBy("row", "doc_id", "n_words").agg(
        F.max(F.when(F.col("template") < 0, F.col("copies"))).alias("copies"), F.coalesce(F.max(part), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(whole & (F.col("template") >= 0), span))).alias("spans"))
    every = rows.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "spans", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return every.drop("copy")


def labels(spans: Column, base_only: bool = False) -> Column:
    """The distinct labels of spans, sorted and joined by commas."""
    kept = F.filter(spans, lambda s: s.base) if base_only else spans
    return F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda s: s.label))), ",")
