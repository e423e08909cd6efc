"""License scan by diagonal voting, DataFrame functions only.

1. Every rolling k-gram of a document's words is hashed and joined to the
   positions of the templates' k-grams; the words themselves are compared
   where hashes meet, so a meeting is exact.
2. A meeting votes for the diagonal (document position - template position):
   the place where the template would begin.
3. Diagonals up to ``slack`` apart are merged, which bridges inserted and
   missing words; the template words that their votes cover are counted.
4. A span is verified if it covers the template's share of words; phrases (``exact``) need
   every word on one diagonal.

The exploded k-grams never leave their task: the templates are broadcast (their
size is checked) and only meetings, plus one row per document, are shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters of all templates together; the bound of the broadcast.
MAX_TEMPLATE_CHARS = 4 << 20
KELVIN = "\u212a"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``cover``: share of the words a span must have; ``exact``: in one unbroken place."""

    label: str
    text: str
    cover: float = 1.0
    exact: bool = False


#: Base phrases of the contract.
PHRASES = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
)

#: Names and notices by which the licenses are known.
NOTICES = (
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("agpl-3", "gnu affero general public license v3"),
    Template("apache-2", "apache license 2 0"),
    Template("bsd-2-clause", "bsd 2 clause license"),
    Template("bsd-3-clause", "bsd 3 clause license"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-nc", "creative commons attribution non commercial"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-2", "gnu general public license v2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-3", "gnu general public license v3"),
    Template("lgpl-2-1", "gnu lesser general public license version 2 1"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("mit", "the mit license"),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("mpl-2", "mozilla public license v 2 0"),
)

#: Passages of the licenses themselves; edited copies count from three quarters on.
PASSAGES = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""", 0.75),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
        all copies.""", 0.75),
    Template("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used
        to endorse or promote products derived from this software without specific prior written permission.""", 0.75),
    Template("apache-2", """you may not use this file except in compliance with the License. You may obtain a copy of
        the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied.""", 0.75),
    Template("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""", 0.95),
    Template("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
        or (at your option) any later version.""", 0.95),
    Template("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/.""", 0.75),
    Template("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means.""", 0.75),
)
TEMPLATES = PHRASES + NOTICES + PASSAGES


@dataclass(frozen=True)
class ScanParams:
    """gram: words of a k-gram, the shortest template's length at most; slack: words by
    which merged diagonals may differ."""

    gram: int = 3
    slack: int = 6


def words_of(text: Column) -> Column:
    """Words of the text with A-Z lower-cased (null: none).

    ``lower`` also folds letters beyond A-Z.  No template can tell, with one
    exception: the Kelvin sign would become the letter k, so it is replaced by
    another letter first.
    """
    t = F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("\u0138"))
    return F.regexp_extract_all(F.lower(t), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession, templates, k: int) -> DataFrame:
    """(h, tid, label, cover, exact, m, tpos, w0..): k-grams of the templates.

    Row -1 stands for "document": it meets the one row every document has.
    """
    if sum(len(t.text) for t in templates) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_CHARS} characters are not broadcast")
    rows = F.array(*[F.struct(F.lit(i).alias("tid"), F.lit(t.label).alias("label"), F.lit(t.cover).alias("cover"),
                              F.lit(t.exact).alias("exact"), F.lit(t.text).alias("text"))
                     for i, t in enumerate(templates)])
    t = spark.range(1, numPartitions=1).select(F.explode(rows).alias("t")).select("t.*").withColumn(
        "ws", words_of(F.col("text")))
    t = t.withColumn("m", F.size("ws"))
    grams = (t.where(F.col("m") >= k).withColumn("tpos", F.explode(F.sequence(F.lit(0), F.col("m") - k)))
             .select(_gram_hash("ws", "tpos", k).alias("h"), "tid", "label", "cover", "exact", "m", "tpos",
                     *[F.get("ws", F.col("tpos") + j).alias(f"w{j}") for j in range(k)]))
    mark = spark.range(1, numPartitions=1).select(
        F.lit(0).cast("long").alias("h"), F.lit(-1).alias("tid"), F.lit("").alias("label"), F.lit(2.0).alias("cover"),
        F.lit(False).alias("exact"), F.lit(1).alias("m"), F.lit(0).alias("tpos"),
        *[F.lit("").alias(f"w{j}") for j in range(k)])
    return grams.unionByName(mark)


def _gram_hash(words: str, at: str, k: int) -> Column:
    return F.xxhash64(*[F.get(words, F.col(at) + j) for j in range(k)])


def votes(docs: DataFrame, templates=TEMPLATES, p: ScanParams | None = None) -> DataFrame:
    """(row, doc_id, n_words, tid, label, cover, exact, m, diagonal, at).

    ``at``: template positions whose k-gram stands there on the diagonal.  Each
    document also has one row with tid -1.
    """
    p = p or ScanParams()
    k = p.gram
    short = [t.text for t in templates if len(re.findall(WORD, t.text.lower())) < k]
    if short:
        raise ValueError(f"templates of fewer than {k} words: {short}")
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("ws"))
    d = d.withColumn("n_words", F.size("ws").cast("long"))
    last = F.greatest(F.size("ws") - k, F.lit(-1))
    g = d.select("*", F.explode(F.sequence(F.lit(-1), last)).alias("pos")).withColumn(
        "h", F.when(F.col("pos") < 0, 0).otherwise(_gram_hash("ws", "pos", k)))
    same = F.lit(True)
    for j in range(k):
        same = same & (F.get("ws", F.col("pos") + j) == F.col(f"w{j}"))
    met = (g.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "h")
           .where(F.when(F.col("pos") < 0, F.col("tid") < 0).otherwise((F.col("tid") >= 0) & same))
           .select("row", "doc_id", "n_words", "tid", "label", "cover", "exact", "m",
                   (F.col("pos") - F.col("tpos")).cast("long").alias("diagonal"), "tpos"))
    # one shuffle: what follows groups by row and more
    return met.repartition("row").groupBy(
        "row", "doc_id", "n_words", "tid", "label", "cover", "exact", "m", "diagonal").agg(
        F.collect_set("tpos").alias("at"))


def spans(docs: DataFrame, templates=TEMPLATES, p: ScanParams | None = None) -> DataFrame:
    """``votes`` with the share of the template's words that the merged diagonals
    cover (``found``), whether that verifies the span (``held``), and its words
    [``first``, ``stop``).

    Merged diagonals differ by ``slack`` at most, so a span is never longer than the template and
    twice the slack.
    """
    p = p or ScanParams()
    v = votes(docs, templates, p)
    near = Window.partitionBy("row", "tid").orderBy("diagonal").rangeBetween(-p.slack, p.slack)
    words = F.array_distinct(F.flatten(F.transform("all", lambda t: F.sequence(t, t + (p.gram - 1)))))
    low, high = F.col("diagonal") + F.array_min("at"), F.col("diagonal") + F.array_max("at") + p.gram
    v = v.withColumns({"all": F.flatten(F.collect_list("at").over(near)), "lo": F.min(low).over(near),
                       "hi": F.max(high).over(near)})
    whole = F.size("at") == F.col("m") - (p.gram - 1)
    v = v.withColumn("found", F.when(F.col("tid") < 0, 0.0).when(F.col("exact"), F.when(whole, 1.0).otherwise(0.0))
                     .otherwise(F.size(words) / F.col("m")))
    return v.select("row", "doc_id", "n_words", "tid", "label", "exact", "diagonal", "found",
                    (F.col("found") >= F.col("cover")).alias("held"),
                    F.when(F.col("exact"), F.col("diagonal")).otherwise(F.col("lo")).alias("first"),
                    F.when(F.col("exact"), F.col("diagonal") + F.col("m")).otherwise(F.col("hi")).alias("stop"))


def scan(docs: DataFrame, templates=TEMPLATES, p: ScanParams | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Base: places of the exact templates.  ``labels`` adds those of the other
    verified spans; ``score`` is the largest share of a template found in one place.
    Texts that are null or hold no word have no places, null first_word and
    last_word, empty labels and score 0; a null doc_id is carried along; repeated
    rows stay; extra columns are ignored; an empty table gives no rows.
    """
    s = spans(docs, templates, p)
    base = F.col("held") & F.col("exact")

    def names(which: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")

    return s.groupBy("row", "doc_id", "n_words").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("held")).alias("labels"),
        F.max("found").alias("score")).drop("row")
