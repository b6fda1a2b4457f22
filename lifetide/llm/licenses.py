"""License scan by canonical digests (operator 3, native).

A text is brought to a canonical form: lower case, copyright lines dropped,
punctuation and blanks collapsed, equivalent spellings unified.  Its digest is
looked up among the digests of known licence texts by a hash join.  The unit of
lookup is an entire text: of the document, of each of its blocks (between blank
lines), of each run of up to as many blocks as the longest known text has and of each of its lines, so a
file that is a licence, a licence pasted into a file (with its blank lines or
without) and a one-line notice are all found by the same exact lookup.

The known texts are a fixed list or a table; their digests are broadcast if there
are at most ``BROADCAST_ROWS``.  With the fixed list, only texts with a trigger word
are cut into units; every known text has one, unbroken, so none is lost.

Defined results: null, empty and licence-free texts get an empty list; a text
that holds a licence twice lists it once and counts both units (runs that end at
one block, with a title and without, count once); repeated rows
get a row each (rows of one doc_id share what was found under it); empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.llm.common import stage, text_or_empty

# ---- Fixed values: known licence texts and notices (identifier, text). ----
_GRANT_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    'modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
    'Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice '
    'shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
    'OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    'PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER '
    'LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR '
    'THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_GRANT_ISC = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, '
    'provided that the above copyright notice and this permission notice appear in all copies.\n\n')
_GRANT_0BSD = 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n'
_DISCLAIM_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    'WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR '
    'CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, '
    'NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.')
_BSD_HEAD = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following '
    'conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and '
    'the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of '
    'conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n')
_BSD_THIRD = (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products '
    'derived from this software without specific prior written permission.\n\n')
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    'BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT '
    'SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL '
    'DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
    'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING '
    'NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.')
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    'License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable '
    'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    'CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
    'limitations under the License.')
KNOWN = (
    ("MIT", _GRANT_MIT),
    ("MIT", "MIT License\n\n" + _GRANT_MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _GRANT_MIT),
    ("ISC", _GRANT_ISC + _DISCLAIM_ISC),
    ("ISC", "ISC License\n\n" + _GRANT_ISC + _DISCLAIM_ISC),
    ("0BSD", _GRANT_0BSD + _DISCLAIM_ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Apache-2.0", _APACHE_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 license."),
    ("All-Rights-Reserved", "All rights reserved."),
)
# Equivalent spellings, on canonical words (pattern, replacement).
SPELLINGS = (
    (r"\blicen[cs]e?ing\b", "licensing"), (r"\blicenced\b", "licensed"), (r"\blicence", "license"), (r"\bsub license", "sublicense"),
    (r"\bv (\d)", "version $1"), (r"\bcopyright (?:owner|holder)", "copyright holder"), (r"\bnon infringement\b", "noninfringement"),
    (r"\bcreative commons attribution\b", "cc by"), (r"\bnon commercial\b", "nc"), (r"\bhttps\b", "http"),
)
# Unbroken words of every known text, one of which each holds: the canonical form neither makes nor breaks words.
TRIGGER = r"(?i)licen[cs]e|permi(?:ssion|tted)|reserved"
BROADCAST_ROWS = 100_000   # digests (about 10 MB)
# Not the wrapped lines of a licence text ("copyright notice and this permission notice", "copyright holders be liable").
NOTICE_LINE = (r"(^|\n)[^a-z0-9\n]*(?:copyright(?![a-z]|[^a-z0-9]+(?:notice|holder|owner|licen[cs]e|law|statement))|©|\(c\) )[^\n]*")

def wrapped(pattern: str) -> str:
    """``pattern`` whose blanks may be line ends (of a wrapped text)."""
    return pattern.replace(" ", r"(?: ?\n ?| )")


def canonical(text: Column) -> Column:
    """Canonical text with its line feeds."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), r"\r\n?", "\n"), NOTICE_LINE, "$1")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    for pattern, same in SPELLINGS:
        out = F.regexp_replace(out, wrapped(pattern), same)
    return out


def flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def digest(flat_text: Column) -> Column:
    return F.sha2(flat_text, 256)


def known_texts(spark: SparkSession) -> DataFrame:
    """The fixed list as (license, text)."""
    return spark.createDataFrame(list(KNOWN), "license string, text string")


class Known:
    """Digests of known texts, and how long a text can be that is one of them."""

    def __init__(self, known: DataFrame):
        body = canonical(text_or_empty())
        rows = (known.select("license", body.alias("_c")).withColumn("_flat", flat(F.col("_c"))).filter("_flat <> ''")
                .select("license", digest(F.col("_flat")).alias("_digest"), F.length("_flat").alias("_chars"), F.size(_blocks(F.col("_c"))).alias("_n")))
        self.digests = stage(rows, "licences")
        most = self.digests.agg(F.max("_n").alias("n"), F.max("_chars").alias("c"), F.count(F.lit(1)).alias("rows")).first()
        self.blocks, self.chars, self.rows = most["n"] or 1, most["c"] or 0, most["rows"]

    def table(self) -> DataFrame:
        """(_digest, license); broadcast if few."""
        out = self.digests.select("_digest", "license").distinct()
        return F.broadcast(out) if self.rows <= BROADCAST_ROWS else out


def _blocks(text: Column) -> Column:
    """Canonical blocks between blank lines that hold a word."""
    return F.filter(F.transform(F.split(text, r"\n *\n"), flat), lambda b: b != "")


def _units(kind: int, texts: Column) -> Column:
    """Units with their place in the text: 3 * index + kind."""
    return F.transform(texts, lambda b, i: F.struct(F.lit(False).alias("whole"), (i * 3 + kind).alias("place"), flat(b).alias("unit")))


def _block_runs(blocks: Column, most: int) -> Column:
    """Runs of 2 to ``most`` blocks, with the place of their last block."""
    def of(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(n - 1), F.size(blocks) - 1), lambda last: F.struct(
            F.lit(False).alias("whole"), (last * 3 + 2).alias("place"), F.array_join(F.slice(blocks, last - (n - 2), n), " ").alias("unit")))
        return F.when(F.size(blocks) >= n, runs)
    none = F.filter(F.transform(blocks, lambda b: F.struct(F.lit(False).alias("whole"), F.lit(0).alias("place"), b.alias("unit"))), lambda u: F.lit(False))
    return F.flatten(F.filter(F.array(none, *map(of, range(2, most + 1))), lambda r: r.isNotNull()))


def scan(docs: DataFrame, known: DataFrame | None = None, trigger: str | None = None) -> DataFrame:
    """doc_id, licenses (sorted, comma-separated), n_units matched, whole_text: the licence that the whole text is.

    ``known``: the known texts (license, text) in place of the fixed list; a
    ``trigger`` pattern, of which every known text has a word, spares the others' cutting."""
    docs = docs.select("doc_id", "text")
    if known is None:
        known, trigger = known_texts(docs.sparkSession), TRIGGER
    known = Known(known)
    text = canonical(text_or_empty())
    units = (docs.filter(F.col("text").rlike(trigger) if trigger else F.col("text").isNotNull())
             .select("doc_id", F.monotonically_increasing_id().alias("_row"), text.alias("_c"))
             # a block that is longer than every known text is cut where it no longer matters
             .withColumn("_b", F.transform(_blocks(F.col("_c")), lambda b: F.substring(b, 1, known.chars + 1)))
             .select("doc_id", "_row", F.explode(F.concat(
                 F.array(F.struct(F.lit(True).alias("whole"), F.lit(-1).alias("place"), flat(F.col("_c")).alias("unit"))),
                 _units(0, F.filter(F.split("_c", r"\n *\n"), lambda b: F.instr(F.trim(b), "\n") > 0)),
                 _units(1, F.split("_c", "\n")),
                 _block_runs(F.col("_b"), known.blocks))).alias("_u")))
    found = (units.select("doc_id", "_row", "_u.whole", "_u.place", digest(F.col("_u.unit")).alias("_digest"))
             .join(known.table(), "_digest", "inner")
             .groupBy(F.col("doc_id").alias("_doc"))
             .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
                  F.count_distinct(F.when(~F.col("whole"), F.struct("_row", "place"))).alias("n_units"),
                  F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_text")))
    return (docs.select("doc_id").join(found, F.col("doc_id") == F.col("_doc"), "left")
            .select("doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("n_units", F.lit(0)).alias("n_units"), "whole_text"))
