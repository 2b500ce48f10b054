"""Licence texts by canonical digest.

A text and its paragraphs and lines are brought to a canonical form: copyright lines go, case is
folded, spellings that mean the same are made one, and what is neither letter nor digit becomes a
blank. The digest of the whole form is looked up among the digests of known licences in a hash join;
nothing is matched in part.

Everything is DataFrame functions. Units are digested where they are read. The known table is
broadcast when it has been counted short, so that documents are not shuffled at all; a longer one is
joined by shuffle on the digest, where adaptive execution splits frequent lines.

Defined cases: null text has no licence; units without letters or digits match nothing; known
licences that are null or canonically empty are ignored, and several with one canonical form are all
reported; rows with the same id are reported as one document; a null id is an id like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.llm.common import whole

BROADCAST_ROWS = 100_000

# Notices and short licences as published.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)
# Lines that name the holder of the rights, and pairs of (spelling, the one it counts as); whole words.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|©|\(c\)|all rights reserved)[^\n]*$"
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("favour", "favor"), ("organisation", "organization"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("v 2", "version 2"), ("v 3", "version 3"), ("v2", "version 2"), ("v3", "version 3"),
)


def canonical(text: Column) -> Column:
    """Lower-case words of the text in canonical spelling, with a blank around each; empty without words."""
    folded = F.lower(text)
    # Both patterns are tested by cheap searches first; most texts contain neither.
    named = folded.contains("copyright") | folded.contains("©") | folded.contains("(c)") | folded.contains("all rights reserved")
    folded = F.when(named, F.regexp_replace(folded, COPYRIGHT_LINE, " ")).otherwise(folded)
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for spelling, standard in SPELLINGS:
        words = F.replace(words, F.lit(f" {spelling} "), F.lit(f" {standard} "))
    return F.when(words != "  ", words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence string, text string")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, licences, whole_text) for every id: the licences found, sorted, and whether one is the whole text.

    ``known(licence, text)`` are the licences looked for.
    """
    digests = known.select("licence", digest(F.col("text")).alias("digest")).filter("licence IS NOT NULL AND digest IS NOT NULL").distinct()
    if digests.count() <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    text = whole(text_col)
    parts = F.concat(
        F.array(F.struct(text.alias("unit"), F.lit(True).alias("whole"))),
        *(
            F.when(F.instr(text, separator) > 0, F.transform(F.split(text, pattern, -1), lambda u: F.struct(u.alias("unit"), F.lit(False).alias("whole"))))
            .otherwise(F.array().cast("array<struct<unit: string, whole: boolean>>"))
            for separator, pattern in (("\n", r"\n"), ("\n\n", r"\n{2,}"))
        ),
    )
    units = docs.select(F.col(id_col).alias("_id"), F.explode_outer(parts).alias("part")).select(
        "_id", F.col("part.whole").alias("whole"), digest(F.col("part.unit")).alias("digest")
    )
    # Rows without a match keep their id, so that one aggregation gives every document.
    matched = units.join(digests, "digest", "left")
    return matched.groupBy("_id").agg(
        F.array_sort(F.collect_set("licence")).alias("licences"),
        F.max(F.col("whole") & F.col("licence").isNotNull()).alias("whole_text"),
    ).select(F.col("_id").alias(id_col), "licences", "whole_text")
