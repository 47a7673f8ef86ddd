"""Licence scans: sparse TF-IDF cosine of files to licence templates, then inheritance along paths.

A template is a notice, the header of a source file, or a licence's text (of the long licences their title and opening).
A file's words are one sequence, whatever its lines and comment marks. Wherever it has a word that speaks of a licence
and that a template has, too, the window of the template's length that lines the two words up is a candidate; so
wrapped headers, whole licence files and notices inside long lines are met as a whole and nothing dilutes them. Each
window and its template are sparse vectors of words weighted by TF-IDF, with the inverse document frequencies of the
templates. Words meet in a join, products are summed per window and template, and of the templates whose cosine
reaches ``cosine`` the one with the most matched weight (its length times the cosine to the power of ``CLOSENESS``) is
the file's own licence: a whole text outweighs a lone "All rights reserved". Templates of fewer than ``SHORT`` words, SPDX
identifiers among them, must be met word for word; a notice of fewer than ``NOTICE`` words does not count where the file
negates it, right before it or inside ("not released under"). A licence file (or the first licensed file
of a directory, where ``licence_file`` says so) gives its licence to its directory. Every file without one of its own
inherits from the nearest ancestor directory that has one, by one join of the file's ancestor paths.

Only DataFrame functions run. The scan keeps files with such a word and nothing else, distinct windows are scored once,
and joins are by word (of the templates alone), by window and by path, each with partial sums; what is large is never
broadcast by hint, templates are.

Defined results: null and empty texts have no licence of their own; a null path is the root; ties go to the
smaller licence name, ties of directory files to the smaller path; repeated files each have a result; without
templates no file has a licence; an empty table gives no rows; other columns are ignored or kept by ``keep``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.llm.common import cut
from quillspan.llm.registry import query, table

COSINE, CLOSENESS = 0.6, 4
# Templates of fewer words than SHORT are met word for word; those below NOTICE say nothing if the file negates them.
SHORT, NOTICE = 5, 20
_NEGATES = {"not", "never", "nor", "neither", "cannot"}
_NEGATED = r"(^| )(not|never|nor|neither|cannot|no longer|isn t|aren t|wasn t)( (yet|currently|been|be|being|now|longer))?$"

# Notices, headers and texts of licences, as they ask for.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, "
    "either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_CC = (
    "Creative Commons {0} 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms "
    'and conditions of this Creative Commons {0} 4.0 International Public License ("Public License").'
)
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of '
        "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License "
        'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language '
        "governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.',
    ],
    "BSD-2-Clause": [_BSD + _AS_IS],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. " + _AS_IS,
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", _CC.format("Attribution")],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", _CC.format("Attribution-NonCommercial")],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", _CC.format("Attribution-ShareAlike")],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain "
        "worldwide. This software is distributed without any warranty.",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        _GNU.format("General Public License", 2),
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. " + _VERBATIM,
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        _GNU.format("General Public License", 3),
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _VERBATIM,
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _GNU.format("Lesser General Public License", 3),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _VERBATIM,
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in '
        "the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
        "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
        "one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns "
        "Covered Software.",
    ],
    "Proprietary": ["All rights reserved."],
}


def _spdx(name: str) -> list[str]:
    """The identifier lines of a licence; those of the GNU family also end in ``-only`` and ``-or-later``."""
    ends = ["", "-only", "-or-later"] if "GPL" in name else [""]
    return [f"SPDX-License-Identifier: {name}{end}" for end in ends]


TEMPLATES = {name: texts if name == "Proprietary" else [*texts, *_spdx(name)] for name, texts in TEMPLATES.items()}
_SPEAKS = r"licen[sc]|copyright|rights|redistribution|public domain|cc0|spdx"
_WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _vectors(counts: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, word, weight`` with weights of length 1, and that ``norm``; words outside ``idf`` count with 1."""
    weighted = counts.join(F.broadcast(idf), "word", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    norms = weighted.groupBy(keys).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.where("idf is not null").join(norms, keys).select(*keys, "word", (F.col("weight") / F.col("norm")).alias("weight"), "norm")


def template_table(spark: SparkSession, templates: dict[str, str | list[str]] | None = None) -> DataFrame:
    given = (TEMPLATES if templates is None else templates).items()
    rows = [(k, line) for k, v in given for line in ([v] if isinstance(v, str) else v)]
    return spark.createDataFrame(rows, "licence string, line string")


def _anchors(texts: list[str]) -> list[tuple[str, int, int, int, bool]]:
    """``(word, place, template, words, affirms)``: where each template first has the words that speak of a licence (its first word if none does).

    ``affirms`` tells notices, which a negating word in their place turns round, from longer texts.
    """
    out = []
    for i, text in enumerate(texts):
        words = re.findall(_WORD, text.lower())
        affirms = len(words) < NOTICE and not _NEGATES & set(words)
        for word in {w for w in words if re.search(_SPEAKS, w)} or set(words[:1]):
            out.append((word, words.index(word), i, len(words), affirms))
    return out


def own_licences(files: DataFrame, templates: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``_row, own, own_cosine`` of the files (``_row, text``) in which a template reaches ``cosine``."""
    spark = files.sparkSession
    given = sorted({(r["licence"], r["line"]) for r in templates.collect() if r["licence"] is not None and r["line"]})
    anchors = _anchors([line for _, line in given])
    if not anchors:
        return files.select("_row", F.lit(None).cast("string").alias("own"), F.lit(None).cast("double").alias("own_cosine")).limit(0)
    numbered = spark.createDataFrame([(i, licence, line) for i, (licence, line) in enumerate(given)], "template int, licence string, line string")
    counts = numbered.select("template", F.explode(_words(F.col("line"))).alias("word")).groupBy("template", "word").agg(F.count(F.lit(1)).alias("tf"))
    counts = cut(counts, "template_words")
    idf = counts.groupBy("word").agg((1 + F.log((1.0 + len(given)) / (1.0 + F.count(F.lit(1))))).alias("idf"))
    vectors = _vectors(counts, idf, ["template"]).withColumnRenamed("weight", "w").withColumnRenamed("norm", "size")

    speaking = sorted({a[0] for a in anchors})
    said = files.where(F.col("text").rlike("(?i)" + "|".join(map(re.escape, speaking)))).select("_row", _words(F.col("text")).alias("words"))
    # The templates of a word are a constant of the plan, so a file's words meet them row by row, without a join or a copy.
    of_word = F.create_map(*(
        part
        for word in speaking
        for part in (F.lit(word), F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("place", "template", "n", "affirms"), a[1:]))) for a in anchors if a[0] == word)))
    ))
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda x: x["word"].isin(speaking))
    said = said.select("_row", "words", F.explode(places).alias("x"))
    said = said.select("_row", "words", F.col("x.at").alias("at"), F.explode(F.element_at(of_word, F.col("x.word"))).alias("a"))
    start = F.greatest(F.col("at") - F.col("a.place"), F.lit(0))
    before = F.array_join(F.slice("words", F.greatest(start - 3, F.lit(0)) + 1, F.least(start, F.lit(3))), " ")
    windows = said.select("_row", "a.template", "a.affirms", F.slice("words", start + 1, F.col("a.n")).alias("window"), before.alias("before"))
    negated = F.col("affirms") & (F.col("before").rlike(_NEGATED) | F.arrays_overlap("window", F.array(*map(F.lit, sorted(_NEGATES)))))
    windows = windows.where(~negated).select("_row", "template", "window")
    windows = cut(windows.withColumn("key", F.unhex(F.md5(F.concat_ws(" ", "window")))), "windows")
    tf = windows.groupBy("template", "key").agg(F.first("window").alias("window"))
    tf = tf.select("template", "key", F.explode("window").alias("word")).groupBy("template", "key", "word").agg(F.count(F.lit(1)).alias("tf"))
    scored = (
        _vectors(tf, idf, ["template", "key"])
        .join(F.broadcast(vectors), ["template", "word"])
        .groupBy("template", "key")
        .agg(F.round(F.sum(F.col("weight") * F.col("w")), 9).alias("cosine"), F.first("size").alias("size"))
        .join(F.broadcast(numbered.select("template", "licence", F.when(F.size(_words(F.col("line"))) < SHORT, 1 - 1e-6).otherwise(cosine).alias("least"))), "template")
        .where(F.col("cosine") >= F.col("least"))
    )
    known = cut(scored.withColumn("matched", F.round(F.col("size") * F.pow("cosine", F.lit(CLOSENESS)), 6)), "known")
    best = F.min(F.struct((-F.col("matched")).alias("m"), "licence", "cosine")).alias("b")
    own = windows.select("_row", "template", "key").join(known, ["template", "key"]).groupBy("_row").agg(best)
    return own.select("_row", F.col("b.licence").alias("own"), F.col("b.cosine").alias("own_cosine"))


def scan_licences(
    files: DataFrame,
    *,
    path: Column,
    licence_file: Column | None = None,
    text_col: str = "text",
    keep: list[str],
    templates: DataFrame | None = None,
    cosine: float = COSINE,
) -> DataFrame:
    """``keep, path, own, own_cosine, licence, licence_from``: a file's own licence and the one that holds for it.

    ``licence_file`` marks files that speak for their directory (by default those called LICENSE, LICENCE or
    COPYING); ``licence_from`` is the file itself or the directory it inherits from.
    """
    spark = files.sparkSession
    templates = template_table(spark) if templates is None else templates
    path = F.coalesce(path.cast("string"), F.lit(""))
    speaks = F.coalesce(licence_file, F.lit(False)) if licence_file is not None else path.rlike(r"(?i)(^|/)(licen[sc]e|copying)[^/]*$")
    text = files[text_col].cast("string")
    # Only texts with a word that some template is found by; equal to what ``own_licences`` looks at.
    speaking = sorted({a[0] for a in _anchors([r["line"] for r in templates.select("line").collect() if r["line"]])})
    rows = files.select(
        F.monotonically_increasing_id().alias("_row"),
        *(files[c].alias(f"k_{c}") for c in keep),
        path.alias("path"),
        speaks.alias("speaks"),
        F.when(text.rlike("(?i)" + "|".join(map(re.escape, speaking)) if speaking else "(?!)"), text).alias("text"),
    )
    rows = cut(rows, "files")
    own = own_licences(rows.select("_row", "text"), templates, cosine)
    rows = cut(rows.drop("text").join(own, "_row", "left"), "own")

    parent = F.regexp_replace("path", "/?[^/]*$", "")
    speakers = rows.where("speaks and own is not null").groupBy(parent.alias("dir"))
    given = cut(speakers.agg(F.min(F.struct("path", "own")).alias("b")).select("dir", F.col("b.own").alias("theirs")), "directories")
    # Each directory that holds unlicensed files asks its ancestors once; files then take their directory's answer.
    asking = rows.where("own is null").select(parent.alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    asked = asking.select("dir", F.posexplode(above).alias("depth", "ancestor"))
    answers = asked.join(given.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir")
    answers = answers.agg(F.max(F.struct("depth", "ancestor", "theirs")).alias("b")).select("dir", F.col("b.ancestor").alias("origin"), F.col("b.theirs").alias("theirs"))
    answers = cut(answers, "answers")
    return (
        rows.withColumn("dir", parent)
        .join(answers, "dir", "left")
        .select(
            *(F.col(f"k_{c}").alias(c) for c in keep),
            "path",
            "own",
            "own_cosine",
            F.coalesce("own", "theirs").alias("licence"),
            F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("origin")).alias("licence_from"),
        )
    )


@query("op2_licences")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # The corpus as a tree of source / thousand ids / ten ids. A third of the documents lies at each of its levels, and
    # the first document with a notice speaks for its directory, so those below search their ancestors.
    folder = lambda n: F.floor(docs["doc_id"] / n).cast("string")
    level = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3
    path = F.concat_ws("/", docs["source"], F.when(level > 0, folder(1000)), F.when(level > 1, folder(10)), docs["doc_id"].cast("string"))
    found = scan_licences(docs, path=path, licence_file=docs["doc_id"].isNotNull(), keep=["doc_id"])
    return found.withColumn("own_cosine", F.round("own_cosine", 6))
