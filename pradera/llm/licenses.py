"""Licence scan by canonical digest, with DataFrame functions only.

A text is brought to a canonical form: lower case, without copyright lines, punctuation and white space as single
spaces, spellings that licence matching treats as equal written one way.  Units of a document (the whole text, its
paragraphs, lines and sentences) are digested in that form and joined by digest with the known licence texts; a unit
matches only as a whole, so a licence quoted in part is no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licence_texts
from .common import stored

# Spellings treated as equal, from -> to (whole words of the canonical form).
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("sub license", "sublicense"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("https", "http"),
]

# Licence texts and the notices that stand for a licence.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
LICENCES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *licence_texts.TEXTS,
]

COPYRIGHT_LINE = (r"(?m)^[^a-z\n]*(copyright([^\n]*[0-9]{4}|[^a-z\n]*(\(c\)|©|by ))|\(c\)[^a-z\n]*[0-9]{4}|©"
                  r"|all rights reserved)[^\n]*$\n?")
# runs of separators (all but letters, digits and the marks) that aren't one space
_SEPARATOR = r"\x00\x03-\x09\x0b-\x1f\x21-\x2f\x3a-\x60\x7b-\x7f\x{a0}-\x{bf}\x{2010}-\x{203a}\x{3000}"
SEPARATORS = f" *[{_SEPARATOR}][ {_SEPARATOR}]*|  +"
SENTENCE_END, SENTENCE = r"([.!?])[ \t]+", "\x01"
PARAGRAPH_END, PARAGRAPH = r"\n[ \t]*\n", "\x02"
LINE = "\n"
MARKS = SENTENCE + PARAGRAPH + LINE


def marked(text: Column) -> Column:
    """Lower-case words without copyright lines; ends of sentences, paragraphs and lines stay as marks, one between
    two words and none outside, all other separators are single spaces."""
    t = F.lower(F.coalesce(text, F.lit("")))
    for mark in (SENTENCE, PARAGRAPH):
        t = F.replace(t, F.lit(mark), F.lit(" "))
    t = F.regexp_replace(t, COPYRIGHT_LINE, "")
    t = F.regexp_replace(F.regexp_replace(t, SENTENCE_END, "$1" + SENTENCE), PARAGRAPH_END, PARAGRAPH)
    t = F.regexp_replace(t, SEPARATORS, " ")
    # of a run the strongest mark; a run is looked at from its first character only, so long ones take linear time
    run, weaker = f" {MARKS}", f" {MARKS}"
    for mark in (PARAGRAPH, LINE, SENTENCE):
        t = F.regexp_replace(t, f"(?<![{run}])[{weaker}]*{mark}[{weaker}]*", mark)
        weaker = weaker.replace(mark, "")
    return F.btrim(t, F.lit(run))


def unmarked(t: Column) -> Column:
    """Canonical form of a marked text or a part of one: marks are spaces, equivalent spellings are one."""
    t = F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), f"[ {MARKS}]+", " ")
    for a, b in EQUIVALENT:
        for _ in range(2):  # neighbours share a space
            t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(t)


def canonical(text: Column) -> Column:
    """Canonical form of a text (empty if nothing but separators and copyright lines is in it)."""
    return unmarked(marked(text))


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LICENCES, "licence string, text string")


def digests(licences: DataFrame) -> DataFrame:
    """``digest``, ``licence``, ``n_chars``, ``first_word`` of the canonical texts; equal texts of several licences
    keep the first by name, empty ones are left out."""
    c = licences.select("licence", canonical(F.col("text")).alias("c")).where("c <> ''")
    return c.groupBy(F.sha2("c", 256).alias("digest"), F.length("c").alias("n_chars"),
                     F.substring_index("c", " ", 1).alias("first_word")).agg(F.min("licence").alias("licence"))


def first_words(known: DataFrame) -> DataFrame:
    """``word``: what a text that is a known one can begin with, before equivalent spellings are made one."""
    first = lambda x: x.split(" ")[0]
    spelled = known.sparkSession.createDataFrame([(first(b), first(a)) for a, b in EQUIVALENT], "to string, word string")
    own = known.select(F.col("first_word").alias("word"))
    return own.union(own.join(spelled, own["word"] == spelled["to"]).select(spelled["word"])).distinct()


def _units(m: Column, limit: Column | int) -> Column:
    """Units of a marked text of ``limit`` characters at most, each with its first word: the whole text, paragraphs of
    several lines, lines of several sentences, sentences (which single lines and paragraphs are)."""
    def head(x):
        x = F.ltrim(x, F.lit(" " + MARKS))
        for mark in " " + MARKS:
            x = F.substring_index(x, mark, 1)
        return x
    short = lambda x: F.length(x) <= limit
    unit = lambda x, word, whole: F.struct(x.alias("u"), word.alias("word"), F.lit(whole).alias("all"))
    of = lambda parts, keep, word: F.transform(F.filter(parts, keep), lambda x: unit(x, word(x), False))
    # behind a line or sentence mark, the first word ends at a space or the unit's end
    plain = lambda x: F.substring_index(F.ltrim(x), " ", 1)
    return F.concat(
        of(F.split(m, f"[{MARKS}]"), short, plain),
        of(F.split(m, f"[{PARAGRAPH}{LINE}]"), lambda x: F.contains(x, F.lit(SENTENCE)) & short(x), head),
        of(F.split(m, PARAGRAPH), lambda x: F.contains(x, F.lit(LINE)) & short(x), head),
        F.filter(F.array(unit(m, head(m), True)), lambda x: F.length(x["u"]) <= limit))


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """Known licences in each document.

    One row per distinct ``doc_id`` (rows that share one are one document): ``n_matches`` (distinct units that are a
    known text), ``licences`` (distinct names in order, joined by commas; empty if none), ``whole_text`` (the entire
    text is a known text).  Null and empty texts match nothing; other columns are not read.

    Units much longer than the longest known text (re-spelling at most halves a length, and marks are single), or that begin with
    a word that no known text begins with, are not digested; the join is on the digest, and a document's matches are
    counted before they are shuffled.
    """
    # read from files of known size, which the planner broadcasts or shuffles by
    known = stored(digests(licences), "licence-digests")
    words = stored(first_words(known), "licence-words")
    longest = known.agg(F.max("n_chars")).first()[0] or 0
    d = docs.select("doc_id", marked(F.col("text")).alias("_m"))
    u = d.select("doc_id", F.explode(_units(F.col("_m"), 2 * longest + 16)).alias("_u"))
    u = u.select("doc_id", "_u", F.col("_u.word").alias("word")).join(words, "word", "left_semi")
    # never null, so no null check of the digest is pushed below the join on the first word, where all units are
    digest = F.coalesce(F.sha2(unmarked(F.col("_u.u")), 256), F.lit(""))
    hits = u.select("doc_id", digest.alias("digest"), F.col("_u.all").alias("_all"))
    found = (hits.join(known, "digest").groupBy("doc_id", "digest", "licence").agg(F.max("_all").alias("_all"))
             .groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_matches"),
                                    F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
                                    F.max("_all").alias("whole_text")))
    none = docs.select("doc_id", F.lit(0).cast("long").alias("n_matches"), F.lit("").alias("licences"),
                       F.lit(False).alias("whole_text"))
    return (none.unionByName(found).groupBy("doc_id")
            .agg(F.max("n_matches").alias("n_matches"), F.max("licences").alias("licences"),
                 F.max("whole_text").alias("whole_text")))


def sql(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of ``scan`` with the known texts of this module."""
    def quote(x):
        for c in MARKS:
            x = x.replace(c, f"\\x{ord(c):02x}")
        return "'" + x.replace("'", "''") + "'"

    def spelled(x, table):
        for a, b in table:
            x = f"replace(replace({x}, ' {a} ', ' {b} '), ' {a} ', ' {b} ')"
        return x
    mark = {c: f"chr({ord(c)})" for c in MARKS}
    sub = lambda x, pattern, to: f"regexp_replace({x}, {quote(pattern)}, {to}, 'g')"

    def marked_sql(x):
        t = f"replace(replace(lower({x}), {mark[SENTENCE]}, ' '), {mark[PARAGRAPH]}, ' ')"
        t = sub(t, COPYRIGHT_LINE, "''")
        t = sub(sub(t, SENTENCE_END, f"'\\1' || {mark[SENTENCE]}"), PARAGRAPH_END, mark[PARAGRAPH])
        return sub(t, SEPARATORS, "' '")
    unmarked_sql = lambda x: "trim(" + spelled(
        sub(f"(' ' || {x} || ' ')", f"[ {MARKS}]+", "' '"), EQUIVALENT) + ")"
    rows = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in LICENCES)
    split = lambda marks: f"regexp_split_to_array(m, {quote(f'[{marks}]')})"
    return f"""
WITH known AS (SELECT c, min(licence) AS licence
               FROM (SELECT licence, {unmarked_sql(marked_sql('t'))} AS c FROM (VALUES {rows}) v(licence, t))
               WHERE c <> '' GROUP BY c),
d AS (SELECT doc_id, {marked_sql("coalesce(text, '')")} AS m FROM {documents}),
u AS (SELECT doc_id, true AS whole, m AS x FROM d
      UNION ALL SELECT doc_id, false, unnest(list_concat({split(PARAGRAPH)}, {split(PARAGRAPH + LINE)}, {split(MARKS)}))
      FROM d),
c AS (SELECT doc_id, {unmarked_sql('x')} AS c, bool_or(whole) AS whole FROM u GROUP BY ALL),
f AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS l, bool_or(whole) AS w
      FROM c JOIN known USING (c) GROUP BY doc_id)
SELECT i.doc_id, coalesce(n, 0) AS n_matches, coalesce(l, '') AS licences, coalesce(w, false) AS whole_text
FROM (SELECT DISTINCT doc_id FROM {documents}) i LEFT JOIN f ON i.doc_id IS NOT DISTINCT FROM f.doc_id
"""
