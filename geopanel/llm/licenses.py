"""License notices found by the Dice coefficient of word bigrams with templates."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.llm.common import pick

# Public licence notices, as projects write them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."),
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the terms of the MIT license.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        'all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file."),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain."),
    "all-rights-reserved": "Copyright. All rights reserved.",
}

#: Keeps sizes at a bound from being lost to rounding.
SLACK = 1e-6


def words_of(text: Column) -> Column:
    """Lower-case words of Latin letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "),
                    lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    """The different pairs of neighbouring words."""
    following = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), following,
        lambda a, b: F.concat(a, F.lit(" "), b)))


def template_bigrams(spark: SparkSession, templates: Mapping[str, str],
                     threshold: float) -> DataFrame:
    """(license, n_template, least, most, bigram); least and most bound the size of a match.

    Dice >= t needs 2 * min(n, m) >= t * (n + m), so n lies between m t / (2 - t) and its
    inverse.
    """
    given = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("template"))
                      for k, v in templates.items()])
    rows = spark.range(1, numPartitions=1).select(F.inline(given))
    rows = rows.withColumn("bigrams", bigrams_of(words_of(F.col("template"))))
    size = F.size("bigrams")
    narrow = threshold / (2 - threshold)
    return rows.select(
        "license", size.alias("n_template"), F.ceil(size * narrow - SLACK).alias("least"),
        F.floor(size / narrow + SLACK).alias("most"), F.explode("bigrams").alias("bigram"))


def markers(templates: Mapping[str, str], threshold: float) -> list[str]:
    """Words of which every text that matches a template holds one at least.

    A match holds m t / (2 - t) of the m bigrams of its template or more, so it has one of any
    set of bigrams that is larger than the rest. Words are taken, long ones before short ones
    and those in most bigrams first, until their bigrams are such a set in each template.
    """
    narrow = threshold / (2 - threshold)
    left, bigrams = {}, {}
    for name, text in templates.items():
        words = _plain_words(text)
        bigrams[name] = {*zip(words, words[1:], strict=False)}
        m = len(bigrams[name])
        left[name] = m - math.ceil(m * narrow - SLACK) + 1 if m else 0
    chosen: list[str] = []

    def gain(word: str) -> tuple:
        new = sum(min(left[n], sum(word in b for b in bigrams[n])) for n in bigrams)
        return len(word) >= 6 and new > 0, new, len(word), word

    while any(n > 0 for n in left.values()):
        word = max((w for n in bigrams if left[n] > 0 for b in bigrams[n] for w in b), key=gain)
        chosen.append(word)
        for name, pairs in bigrams.items():
            hit = {b for b in pairs if word in b}
            left[name] = max(0, left[name] - len(hit))
            bigrams[name] = pairs - hit
    return chosen


def license_matches(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES,
                    threshold: float = 0.8) -> DataFrame:
    """doc_id, unit, at, license, n_bigrams, n_template, n_shared, dice: all matches.

    Compared are whole texts (unit 'text', at 0), lines ('line', from 1) and, where blank
    lines divide a text, its paragraphs ('paragraph', from 1), normalised to lower-case words
    of a-z and 0-9. dice is twice the shared bigrams over both counts of different bigrams.
    Texts without any of the ``markers`` match nothing and are not taken apart. Units whose
    size rules out every template are dropped before their bigrams are looked up;
    the rest meet a template only in a bigram, and only within its size bounds. Templates
    are parameters of the code, so their table is broadcast; documents are not shuffled, only
    the bigrams they share with a template are, counted by task.

    Ties are all returned. Null and empty texts match nothing; repeated rows match each for
    itself. Extra columns are ignored; an empty table gives an empty result.
    """
    given = template_bigrams(docs.sparkSession, templates, threshold)
    narrow = threshold / (2 - threshold)
    sizes = [len({*zip(w, w[1:])}) for w in map(_plain_words, templates.values())]
    low, high = min(sizes) * narrow - SLACK, max(sizes) / narrow + SLACK
    # Whole words of letters and digits. No template with a bigram, no match.
    known = f"(?<![a-z0-9])(?:{'|'.join(markers(templates, threshold)) or '$.'})(?![a-z0-9])"
    rows = pick(docs, "doc_id", "text").filter(F.lower("text").rlike(known)).withColumn(
        "row", F.monotonically_increasing_id())
    text = F.col("text")
    lines = F.split(text, "\n", -1)
    paragraphs = F.split(text, r"\n[ \t\r]*\n", -1)

    def units(kind: str, parts: Column, when: Column) -> Column:
        listed = F.transform(parts, lambda part, i: F.struct(
            F.lit(kind).alias("unit"), (i + 1).alias("at"), part.alias("part")))
        return F.when(when, listed).otherwise(F.slice(listed, 1, 0))

    whole = F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("at"),
                             text.alias("part")))
    cut = rows.select("row", "doc_id", F.explode(F.concat(
        whole, units("line", lines, F.size(lines) > 1),
        units("paragraph", paragraphs, F.size(paragraphs) > 1))).alias("u")).select(
        "row", "doc_id", "u.unit", "u.at", words_of(F.col("u.part")).alias("words"))
    sized = cut.filter(F.size("words") > low).withColumn(
        "bigrams", bigrams_of(F.col("words"))).withColumn("n", F.size("bigrams"))
    sized = sized.filter((F.col("n") >= low) & (F.col("n") <= high))
    met = sized.select("row", "doc_id", "unit", "at", "n", F.explode("bigrams").alias("bigram")
                       ).join(F.broadcast(given), "bigram").filter("n BETWEEN least AND most")
    counted = met.groupBy("row", "doc_id", "unit", "at", "license", "n", "n_template").agg(
        F.count("*").alias("n_shared"))
    dice = 2.0 * F.col("n_shared") / (F.col("n") + F.col("n_template"))
    return counted.withColumn("dice", dice).filter(F.col("dice") >= threshold).select(
        "doc_id", "unit", "at", "license", F.col("n").alias("n_bigrams"), "n_template",
        "n_shared", "dice")


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
