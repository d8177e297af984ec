"""License scans by diagonal voting, in DataFrame functions only.

Templates are short license notices and whole license texts, of any length.
Every gram of a text, two consecutive words for short templates and four for
long ones, is hashed and joined with the grams of all templates, which are a
fixed list and therefore broadcast; the words themselves are compared as well.
A match at word p of the text and word q of the template votes for diagonal
p - q, the place where the template would start. Votes are kept as the sorted
template places, so a repeated row or word counts once. Votes of a diagonal and
its next neighbours, where words were put in, are merged. Where the merged votes
cover enough of the template's words, the span is verified: the longest
alignment of voted words, in order in both the text and the template, must cover
as much.

A phrase stands at a place exactly if its diagonal has every vote; the base
labels are counted that way.

Null and empty texts have no words and no labels. Repeated rows give repeated
results. An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import one_of_each

# Phrases that are labels wherever they stand.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Usual license notices, as folded words.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
)
# Whole license texts, without their copyright lines.
TEXTS = (
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    ),
)
# A span is accepted from this share of the template's words on.
COVERAGE = 0.8
# From this many words on a template is long.
LONG_WORDS = 32
# Words of a gram, and how many words may have been put in, for short and long templates.
GRAM, LONG_GRAM = 2, 4
DRIFT, LONG_DRIFT = 2, 16

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def templates(base: tuple, notices: tuple) -> list[tuple[str, list[str], int, int]]:
    """(label, folded words, words of a gram, drift) of every template, base phrases first."""
    out = []
    for i, (label, text) in enumerate([*base, *notices]):
        words = re.findall(_WORD, text.translate(str.maketrans(_UPPER, _UPPER.lower())))
        if len(words) < GRAM:
            raise ValueError(f"a template has {GRAM} words at least")
        long = i >= len(base) and len(words) >= LONG_WORDS
        out.append((label, words, LONG_GRAM if long else GRAM, LONG_DRIFT if long else DRIFT))
    return out


def template_grams(spark: SparkSession, entries: list) -> DataFrame:
    """`(t, at, k, gram)` for every `k` consecutive words of every template."""
    listed = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.lit(k).alias("k"), F.split(F.lit(" ".join(words)), " ").alias("w"))
            for t, (_, words, k, _) in enumerate(entries)
        ]
    )
    each = spark.range(1).select(F.explode(listed).alias("e")).select("e.t", "e.k", "e.w")
    placed = each.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("k"))))
    return placed.select("t", "at", F.col("k").alias("of"), F.slice("w", F.col("at") + 1, F.col("k")).alias("gram"))


def _of_template(values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("t"))


def _hash_of(word, lengths: list[int]) -> Column:
    """Hash of the gram of `k` words, `word(j)` being its j-th."""
    out = None
    for k in lengths:
        value = F.xxhash64(*[word(j) for j in range(k)])
        out = F.when(F.col("k") == k, value) if out is None else out.when(F.col("k") == k, value)
    return out


def _aligned(width: Column, n: Column) -> Column:
    """Words of the longest alignment of `cells` (template place * width + offset of the diagonal).

    One step per template word. `best` holds, for each diagonal of the band, the
    longest alignment that ends there; a word put into the text leads to the
    next diagonal, a word of the template left out to the one before.
    """

    def step(best: Column, q: Column) -> Column:
        grown = F.transform(
            best,
            lambda x, j: F.greatest(
                x + F.when(F.array_contains("cells", q * width + j), 1).otherwise(0),
                F.coalesce(F.get(best, j + 1), F.lit(0)),
            ),
        )
        return F.aggregate(
            grown,
            F.array().cast("array<int>"),
            lambda row, x: F.array_append(row, F.greatest(x, F.coalesce(F.get(row, F.size(row) - 1), F.lit(0)))),
        )

    return F.array_max(F.aggregate(F.sequence(F.lit(0), n - 1), F.array_repeat(F.lit(0), width), step))


def scan(
    docs: DataFrame,
    base: tuple = BASE,
    notices: tuple = NOTICES + TEXTS,
    coverage: float = COVERAGE,
) -> DataFrame:
    """`docs(doc_id, text)` -> one row per row.

    doc_id, n_words, n_base, first_word, last_word, base_labels and labels
    (sorted arrays), score (the best coverage of an accepted span, else 0) and
    spans: label, start, end (words) and coverage of every accepted span.
    """
    entries = templates(base, notices)
    lengths = sorted({k for _, _, k, _ in entries})
    grams = template_grams(docs.sparkSession, entries)
    listed = F.broadcast(
        grams.withColumn("k", F.col("of")).withColumn("hash", _hash_of(lambda j: F.get("gram", F.lit(j)), lengths)).drop("k")
    )
    words = one_of_each(docs, "doc_id", "text").select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.coalesce(
            F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit(_WORD), F.lit(0)),
            F.array().cast("array<string>"),
        ).alias("words"),
    )
    words = words.withColumn("n_words", F.size("words"))
    # Place -1 stands for the text itself, so that every row survives the join.
    places = words.select(
        "doc_id",
        "text_key",
        "words",
        "n_words",
        F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n_words") - GRAM, F.lit(-1)))).alias("place"),
    )
    each = F.when(F.col("place") < 0, F.array(F.lit(0))).otherwise(F.array(*[F.lit(k) for k in lengths]))
    hashed = places.withColumn("k", F.explode(each)).withColumn(
        "h", _hash_of(lambda j: F.get("words", F.col("place") + j), lengths)
    )
    met = hashed.join(
        listed,
        (F.col("h") == F.col("hash"))
        & (F.col("k") == F.col("of"))
        & (F.slice("words", F.greatest(F.col("place") + 1, F.lit(1)), F.col("k")) == F.col("gram")),
        "left",
    ).where((F.col("place") < 0) | F.col("t").isNotNull())
    # Only narrow rows reach the aggregate, which sorts them once it holds many groups.
    met = met.select("doc_id", "text_key", "t", "at", "n_words", (F.col("place") - F.col("at")).alias("diagonal"))
    diagonals = met.groupBy("doc_id", "text_key", "t", "diagonal").agg(
        F.array_sort(F.collect_set("at")).alias("votes"),
        F.max("n_words").alias("n_words"),
        F.count("*").alias("times"),
    )
    n, k = _of_template([len(w) for _, w, _, _ in entries]), _of_template([k for _, _, k, _ in entries])
    width = _of_template([drift + 1 for *_, drift in entries])
    of_text = Window.partitionBy("doc_id", "text_key", "t").orderBy("diagonal")

    def near(value: Column, first: int, last: int) -> Column:
        """An aggregate over the neighbours from `first` to `last` drifts away."""
        out = None
        for drift in sorted({drift for *_, drift in entries}):
            end = drift * last if last >= 0 else last
            over = value.over(of_text.rangeBetween(drift * first, end))
            out = F.when(width == drift + 1, over) if out is None else out.when(width == drift + 1, over)
        return out

    is_base = (F.col("t") < len(base)) & (F.size("votes") == n - k + 1)
    # The words that a vote covers, by template place and offset of the diagonal.
    cells = F.flatten(
        F.transform(
            "band",
            lambda b: F.flatten(
                F.transform(
                    b["votes"],
                    lambda v: F.transform(F.sequence(v, v + k - 1), lambda q: q * width + (b["diagonal"] - F.col("diagonal"))),
                )
            ),
        )
    )
    covered = F.size(F.array_distinct(F.transform("cells", lambda c: F.floor(c / width))))
    spans = (
        diagonals.withColumn("band", near(F.collect_list(F.struct("diagonal", "votes")), 0, 1))
        .withColumn("cells", F.when(F.col("t").isNotNull(), F.array_distinct(cells)))
        .withColumn("is_base", F.coalesce(is_base, F.lit(False)))
        .where(F.col("t").isNull() | F.col("is_base") | (covered / n >= coverage))
        .withColumn("share", F.when(F.col("t").isNotNull(), _aligned(width, n) / n))
        .withColumn("start", F.array_min(F.transform("band", lambda b: b["diagonal"] + F.array_min(b["votes"]))))
        .withColumn("end", F.array_max(F.transform("band", lambda b: b["diagonal"] + F.array_max(b["votes"]))) + k)
    )
    accepted = F.col("share") >= coverage
    # Of neighbours that are accepted for the same words, the best, then the first.
    best_near = near(F.max(F.when(accepted, F.col("share"))), -1, 1)
    earlier = near(F.max(F.when(accepted, F.col("share"))), -1, -1)
    chosen = accepted & (F.col("share") == best_near) & (earlier.isNull() | (earlier < F.col("share")))
    spans = spans.drop("band", "cells").withColumn("chosen", F.coalesce(chosen, F.lit(False)))
    label = _of_template([name for name, *_ in entries])
    span = F.struct(label.alias("label"), "start", "end", F.col("share").alias("coverage"))
    found = spans.groupBy("doc_id", "text_key").agg(
        F.max(F.when(F.col("t").isNull(), F.col("n_words"))).cast("long").alias("n_words"),
        F.max(F.when(F.col("t").isNull(), F.col("times"))).alias("times"),
        F.count(F.when(F.col("is_base"), 1)).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("is_base"), label))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(F.col("is_base") | F.col("chosen"), label))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("chosen"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("chosen"), span))).alias("spans"),
    )
    # Rows that agree in id and text were counted together.
    return found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("row", "times", "text_key")
