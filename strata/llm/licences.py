"""Licence scan by canonical digest.

A text is brought to a canonical form (below) and hashed; the digest is joined
with the digests of known licences, so a hit means that the *entire* text is
that licence, up to case, punctuation, white space, copyright lines and
equivalent spellings.  The same lookup is made for every line of a text, which
finds one-line notices inside documents.  DataFrame functions only.

Known are the texts of ``KNOWN`` and, by their digests, the licences of
``licence_digests.py`` in their usual variants.

Canonical form: lower case; lines that begin with "copyright", "(c)" or the
copyright sign, also behind comment marks, are dropped; every run of ASCII or typographic punctuation and
ASCII white space becomes one space; equivalent spellings are replaced word by
word; no space at either end.

Defined results: a null or empty text has the digest of the empty form and no
licence (no known licence is empty); repeated rows give repeated rows; several
known texts with one digest count as the first by id; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents
from strata.llm.licence_digests import DIGESTS

COPYRIGHT_MARKS = ("copyright", "(c)", "©")
#: A copyright line, also behind comment marks; one class of marks, so a line of any number of them is read without recursion.
COPYRIGHT_LINE = r"(^|\n)[-#/*(;%<!{\"'| \t]*(copyright|\(c\)|©)[^\n]*"
SEPARATORS = r"[\t\n\x0B\f\r !-/:-@\[-`{-~‘’“”–—…«»•·©]+"

#: Spellings that count as one (from the public licence matching guidelines).
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

#: Parts of words of which every known text holds one, however it is spelt.
STEMS = ("licen", "software")

#: Public licence texts and one-line notices.
KNOWN = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-line": "Released under the MIT License.",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}


def canonical(text: Column) -> Column:
    """The canonical form of a text (null: empty)."""
    def without_copyright(t: Column) -> Column:
        return F.when(_holds(t, COPYRIGHT_MARKS), F.regexp_replace(t, COPYRIGHT_LINE, "\n")).otherwise(t)

    def one_spelling(t: Column) -> Column:
        other = t
        for word, same in EQUIVALENT.items():
            other = F.replace(other, F.lit(f" {word} "), F.lit(f" {same} "))
        # Most texts hold none of the words: one look instead of a pass for each.
        return F.when(F.rlike(t, F.lit(f" ({'|'.join(EQUIVALENT)}) ")), other).otherwise(t)

    t = _with(F.lower(F.coalesce(text, F.lit(""))), without_copyright)
    # Two spaces between words, so each word has a space of its own on either side.
    t = _with(F.concat(F.lit(" "), F.regexp_replace(t, SEPARATORS, "  "), F.lit(" ")), one_spelling)
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _holds(text: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: Mapping[str, str] = KNOWN, digests: Mapping[str, str] = DIGESTS) -> DataFrame:
    """(digest, licence) of the known texts and digests: one row a digest, bounded by the lists."""
    rows = F.array(*[F.struct(F.lit(k).alias("licence"), F.lit(v).alias("body")) for k, v in sorted(known.items())])
    table = spark.range(1).select(F.inline(rows)).select(digest(F.col("body")).alias("digest"), "licence")
    if digests:
        rows = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(k).alias("licence")) for d, k in digests.items()])
        table = table.union(spark.range(1).select(F.inline(rows)))
    return table.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text_digest`` and ``text_licence`` (the whole text is that licence)."""
    found = known.select(F.col("digest").alias("_digest"), F.col("licence").alias("text_licence"))
    out = docs.withColumn("text_digest", digest(F.col(text)))
    return out.join(F.broadcast(found), F.col("text_digest") == F.col("_digest"), "left").drop("_digest")


def notices(docs: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id",
            stems: Sequence[str] = STEMS) -> DataFrame:
    """(key, licence, lines): known texts that are a whole line of a document.

    Every known text must hold one of ``stems`` in all its spellings; lines that
    hold none cannot match and are not hashed."""
    found = known.select(F.col("digest").alias("_digest"), "licence")
    lines = docs.where(_holds(F.lower(F.col(text)), stems)).select(key, F.explode(F.split(F.col(text), "\n")).alias("_line"))
    lines = lines.where(_holds(F.lower(F.col("_line")), stems))
    lines = lines.select(key, digest(F.col("_line")).alias("_d"))
    return (lines.join(F.broadcast(found), F.col("_d") == F.col("_digest"))
                 .groupBy(key, "licence").agg(F.count("*").alias("lines")))


def op8_licence_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: canonical digest, licence of the whole text, licences found as whole lines."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    known = known_digests(spark)
    whole = scan(docs, known).select("doc_id", "text_digest", "text_licence")
    per_doc = (notices(docs, known).groupBy(F.col("doc_id").alias("_doc"))
               .agg(F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("notices"),
                    F.sum("lines").alias("notice_lines")))
    return whole.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", "text_digest", "text_licence", F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("notice_lines", F.lit(0)).cast("long").alias("notice_lines"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    t = f"lower(coalesce({text}, ''))"
    t = f"regexp_replace({t}, {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    t = f"' ' || regexp_replace({t}, {_sql_text(SEPARATORS)}, '  ', 'g') || ' '"
    for word, same in EQUIVALENT.items():
        t = f"replace({t}, ' {word} ', ' {same} ')"
    return f"trim(replace({t}, '  ', ' '), ' ')"


def oracle() -> str:
    known = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in sorted(KNOWN.items()))
    more = ", ".join(f"('{d}', '{k}')" for d, k in DIGESTS.items())
    return f"""
    WITH known AS (SELECT digest, min(licence) AS licence
                   FROM (SELECT sha256({_canonical_sql('body')}) AS digest, licence FROM (VALUES {known}) AS k(licence, body)
                         UNION ALL SELECT digest, licence FROM (VALUES {more}) AS d(digest, licence)) GROUP BY 1),
    whole AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS text_digest FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    found AS (SELECT l.doc_id, k.licence, count(*) AS n
              FROM (SELECT doc_id, sha256({_canonical_sql('line')}) AS d FROM lines) l
              JOIN known k ON k.digest = l.d GROUP BY 1, 2),
    per_doc AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS notices, sum(n)::BIGINT AS notice_lines
                FROM found GROUP BY 1)
    SELECT w.doc_id, w.text_digest, k.licence AS text_licence, coalesce(p.notices, '') AS notices,
           coalesce(p.notice_lines, 0) AS notice_lines
    FROM whole w LEFT JOIN known k ON k.digest = w.text_digest LEFT JOIN per_doc p ON p.doc_id = w.doc_id
    """
