"""License scans by diagonal voting.

Every word k-gram of a document is hashed and joined with the k-gram hashes of
the license templates. A match at document position p and template position t
votes for the diagonal p - t. Votes are summed by diagonal. Inserted or missing
words (a copyright line, a clause) shift the rest to another diagonal, so
neighbouring diagonals are merged: their distance may be a share of the
template's length, or a paragraph put in, but diagonals of single stray votes
only join what is very near. The merged span is verified: it has to cover most
of the template's words and may be longer only by so many words put in. Beside it, short phrases are
looked up literally. Texts of licenses are held by paragraph, since documents
quote them in parts.

DataFrame functions only; the templates are a fixed table of some hundred
rows. k-grams are known by 64-bit hashes. Defined results: null and empty texts
have no words, labels or places; texts of any length are scanned whole;
repeated rows get equal results (of a text's spans for one template, all are
returned); ties keep the smaller position; a null id is a value like any
other; an empty table gives no rows; further columns, whatever their names,
are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.llm.text import fold_ascii

K = 5
COVER = 0.8  # share of the template's words that a span has to cover
STRETCH = 1.6  # longest span, in lengths of the template
NEAR = 4  # diagonals this close are one alignment
SHIFT = 0.5  # farther ones too, up to this share of the template's length, if they hold votes enough
INSERTED, INSERTED_SHARE = 60, 1.2  # as many words may stand in between in any case, but no more than this share of a short template
NAMED = 0.5  # score of a text that only names a license
VOTES = 3  # for that, or all grams of a template with fewer
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

# Paragraphs of published license texts and usual notices, by label.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit-conditions", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("warranty-text", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-text", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl-text", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-liability", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-sa-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc0-text", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."),
)


def split_words(text: Column) -> Column:
    """Words of the folded text: runs of 0-9, a-z and all beyond ASCII."""
    return F.filter(F.split(fold_ascii(text), GAP), lambda w: w != "")


def grams(words: str, k: int) -> Column:
    """Rolling k-gram hashes of a column of word hashes."""
    parts = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return F.expr(f"CASE WHEN size({words}) < {k} THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts})) END")


def template_grams(spark, templates=TEMPLATES, k: int = K) -> DataFrame:
    """template, t, gram and the template's length in words."""
    rows = [(label, [w for w in re.split(GAP, text.lower()) if w]) for label, text in templates]
    df = spark.createDataFrame(rows, "template string, words array<string>")
    df = df.withColumn("__h", F.transform("words", lambda w: F.xxhash64(w)))
    return df.select("template", F.size("words").alias("t_words"), F.posexplode(grams("__h", k)).alias("t", "gram"))


def scan(docs: DataFrame, templates=TEMPLATES, k: int = K, cover: float = COVER) -> DataFrame:
    """doc_id, digest (of the text), template, first and last word, score of the best verified span of every stretch."""
    table = template_grams(docs.sparkSession, templates, k)
    d = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w)).alias("__h"))
    each = d.select("doc_id", "digest", F.posexplode(grams("__h", k)).alias("p", "gram"))
    hits = each.join(F.broadcast(table), "gram")  # a row for each word of the templates
    key = ["doc_id", "digest", "template"]
    # votes by diagonal; repeated rows vote once
    diagonals = hits.groupBy(*key, "t_words", (F.col("p") - F.col("t")).alias("diagonal")).agg(F.min("p").alias("p0"), F.max("p").alias("p1"), F.sort_array(F.collect_set("t")).alias("ts"))
    w = W.partitionBy(*key).orderBy("diagonal", "p0")
    # diagonals with votes enough chain over a gap of the template's measure; the others only extend a chain very near
    firm = F.when(F.size("ts") >= F.least(F.lit(VOTES), F.col("t_words") - k + 1), F.col("diagonal"))
    before, after = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)
    near = diagonals.withColumns({"firm": firm, "low": F.last(firm, ignorenulls=True).over(before), "high": F.first(firm, ignorenulls=True).over(after), "upto": F.last(F.when(firm.isNotNull(), F.element_at("ts", -1)), ignorenulls=True).over(before)})
    inserted = F.least(F.lit(float(INSERTED)), INSERTED_SHARE * F.col("t_words"))
    gap, usual = F.col("diagonal") - F.col("low"), F.greatest(F.lit(float(NEAR)), SHIFT * F.col("t_words"))
    # beyond the usual measure the template has to go on where it was left; else it is another copy
    apart = F.coalesce((gap > F.greatest(usual, inserted)) | ((gap > usual) & (F.element_at("ts", 1) <= F.col("upto"))), F.lit(True))
    chains = near.withColumn("__c", F.when(F.col("firm").isNotNull(), F.sum(F.when(F.col("firm").isNotNull() & apart, 1).otherwise(0)).over(w)))
    low, high = F.last("__c", ignorenulls=True).over(before), F.first("__c", ignorenulls=True).over(after)
    islands = chains.withColumn("__i", F.coalesce("__c", F.when(F.col("diagonal") - F.col("low") <= NEAR, low), F.when(F.col("high") - F.col("diagonal") <= NEAR, high))).filter("__i IS NOT NULL")
    spans = islands.groupBy(*key, "t_words", "__i").agg(F.min("p0").alias("first_word"), (F.max("p1") + k - 1).alias("last_word"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("ts"))
    covered = F.expr(f"aggregate(transform(ts, (x, i) -> CASE WHEN i = size(ts) - 1 THEN {k} ELSE least({k}, ts[least(i + 1, size(ts) - 1)] - x) END), 0, (a, x) -> a + x)")
    spans = spans.withColumn("score", covered / F.col("t_words"))
    fits = (F.col("score") >= cover) & (F.col("last_word") - F.col("first_word") + 1 <= F.greatest(STRETCH * F.col("t_words"), F.col("t_words") + inserted))
    spans = spans.filter(fits)
    # of templates that resemble each other, the one that fits a stretch best
    where = W.partitionBy("doc_id", "digest").orderBy("first_word", "last_word", "template")
    apart = F.coalesce(F.col("first_word") > F.max("last_word").over(where.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    stretches = spans.withColumn("__new", apart.cast("int")).withColumn("__s", F.sum("__new").over(where))
    best = stretches.groupBy("doc_id", "digest", "__s").agg(F.max_by(F.struct("template", "first_word", "last_word", "score"), F.struct("score", "t_words", "template")).alias("b"))
    return best.select("doc_id", "digest", "b.template", F.col("b.first_word").cast("long").alias("first_word"), F.col("b.last_word").cast("long").alias("last_word"), "b.score")


def places(words: str, phrase: tuple[str, ...]) -> str:
    """SQL for the starts of a phrase in a column of words."""
    same = " AND ".join(f"{words}[i + {j}] = '{w}'" for j, w in enumerate(phrase))
    n = len(phrase)
    return f"CASE WHEN size({words}) < {n} THEN CAST(array() AS array<int>) ELSE filter(sequence(0, size({words}) - {n}), i -> {same}) END"


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (best cover of a template) of every document."""
    docs = docs.select("doc_id", "text")
    d = docs.select("doc_id", F.xxhash64("text").alias("digest"), split_words(F.col("text")).alias("w"))
    d = d.withColumn("v", F.when(F.array_contains("w", "license"), F.col("w")).otherwise(F.array().cast("array<string>")))
    for i, (phrase, _) in enumerate(PHRASES):
        d = d.withColumn(f"p{i}", F.expr(places("v", phrase)))
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    labels = F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)])))
    base = d.select("doc_id", "digest", F.size("w").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), labels.alias("base"))
    found = scan(docs).groupBy(F.struct("doc_id", "digest").alias("key")).agg(F.collect_set("template").alias("own"), F.max("score").alias("own_score"))
    both = base.withColumn("key", F.struct("doc_id", "digest")).join(found, "key", "left")
    all_labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("own", F.array().cast("array<string>")))))
    score = F.greatest(F.coalesce("own_score", F.lit(0.0)), F.when(F.size("base") > 0, F.lit(NAMED)).otherwise(F.lit(0.0)))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(all_labels, ",").alias("labels"), score.alias("score"))
