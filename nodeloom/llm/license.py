"""License scans: canonical digest lookup.

A text is reduced to canonical form: ASCII lower case; copyright lines dropped;
ASCII punctuation and white space to single spaces; equivalent spellings to one.
The SHA-256 of the form is hash-joined to the digests of known license texts. The
unit is an entire text: the whole document, and each of its lines for notices and
licenses on one line. Only the table of known digests, a few dozen rows, is broadcast.
Full texts are the files of the folder ``licenses``, named by license, which the
driver alone reads.

A copyright line begins with the word or sign and names a year, a place for one, or a
holder and nothing else; prose that a line break happens to begin with "copyright"
(holders, notice, license ...) stays, so that the form does not depend on wrapping.

Null texts count as empty; an empty form matches nothing. Rows are matched one by
one; repeated rows give repeated results; an empty table gives an empty result; other columns are
ignored. Texts and lines of any length are read whole, in time linear in their length.
Of two known texts with one form the license first by name is given.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeloom.llm.common import ascii_lower

#: What may stand before a copyright sign on its line.
_LEAD = r"^[ \t#*/;-]*"
#: Words that continue "copyright" in the prose of licenses, not in a holder's name (fixed values).
PROSE = ("and", "as", "disclaimer", "disclaimers", "holder", "holders", "in", "interest", "interests", "is", "law", "laws", "licence", "license", "licenses", "notice", "notices", "on", "or", "owner", "owners", "over", "permission", "protection", "rights", "statement", "statements", "the", "this", "to", "treaty", "under", "was", "work")
#: Lines that vary from copy to copy of a license: a sign or year behind "copyright", a bare sign, a holder's name alone, the reservation alone.
COPYRIGHT_LINE = (
    rf"(?m){_LEAD}(?:copyright[ \t:,]*(?:\(c\)|©|[<\[{{(]?(?:[0-9]{{4}}\b|y{{2,4}}\b|year\b))[^\n]*|(?:\(c\)|©)[^\n]*"
    rf"|copyright[ \t:]+(?!(?:{'|'.join(PROSE)})\b)[^\n.;]{{1,80}}\.?|all rights reserved[ \t.]*)$"
)
#: Everything in ASCII that is neither letter nor digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Equivalent spellings in canonical form (fixed values, after the public SPDX matching guidelines).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("behaviour", "behavior"), ("catalogue", "catalog"), ("centre", "center"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"),
    ("modelling", "modeling"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("organisations", "organizations"), ("owner", "holder"), ("owners", "holders"), ("programme", "program"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
)

_AS_IS_MIT = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
"""
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_AS_IS_ISC = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'

#: Known texts (fixed values: public license texts and the one-line notices in use).
KNOWN = (
    ("MIT", _MIT + _AS_IS_MIT), ("MIT", "MIT License\n" + _MIT + _AS_IS_MIT),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n{_AS_IS_ISC}"), ("0BSD", f"{_ISC}.\n{_AS_IS_ISC}"),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."), ("BSD-3-Clause", "Released under the BSD 3-Clause License."), ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)


def canonical(text: Column) -> Column:
    """Canonical form of an entire text."""
    bare = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    # two spaces between words, so that neighbours do not share one and each is replaced
    return spelt(F.concat(F.lit(" "), F.btrim(F.regexp_replace(bare, SEPARATORS, "  ")), F.lit(" ")))


def spelt(padded: Column) -> Column:
    for said, meant in SPELLINGS:
        padded = F.replace(padded, F.lit(f" {said.replace(' ', '  ')} "), F.lit(f" {meant} "))
    return F.btrim(F.replace(padded, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the files, each also without what follows its terms, BSD texts also with unnumbered clauses; all of them also on one line."""
    found = []
    for file in resources.files("nodeloom.llm").joinpath("licenses").iterdir():
        if file.name.endswith(".txt"):
            name, text = file.name[:-4], file.read_text(encoding="utf-8")
            found.append((name, text))
            head, end, _ = text.partition("END OF TERMS AND CONDITIONS")
            found += [(name, head), (name, head + end)] if end else []
            found += [(name, re.sub(r"(?m)^\d\. ", "* ", text))] if name.startswith("BSD-") else []
    return found + [(name, " ".join(text.split())) for name, text in found]


def known(spark: SparkSession) -> DataFrame:
    """digest, license, form (canonical) of all known texts, one row for each digest."""
    texts = spark.createDataFrame([*KNOWN, *full_texts()], "license string, text string").select(canonical(F.col("text")).alias("form"), "license")
    return texts.groupBy("form").agg(F.min("license").alias("license")).select(F.sha2(F.col("form").cast("binary"), 256).alias("digest"), "license", "form")


def first_words(forms: list[str]) -> set[str]:
    """Words that a line can begin with, if its canonical form is one of these."""
    words = {form.split(" ", 1)[0] for form in forms}
    while more := {said.split()[0] for said, meant in SPELLINGS if meant.split()[0] in words} - words:
        words |= more
    return words


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license (of the whole text, or null), n_notices (lines that are a known text), notices (their distinct licenses), digest."""
    spark = docs.sparkSession
    table = known(spark)
    texts = table.collect()  # a few dozen rows: the known texts themselves
    table = spark.createDataFrame([(r["digest"], r["license"]) for r in texts], "digest string, license string")
    of_line = F.create_map(*[F.lit(x) for r in texts for x in (r["digest"], r["license"])])
    begins = rf"(?i)^{SEPARATORS[:-1]}*(?:{'|'.join(sorted(first_words([r['form'] for r in texts])))})(?:{SEPARATORS[:-1]}|$)"
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(begins))
    found = F.filter(F.transform(lines, lambda x: F.try_element_at(of_line, digest(x))), lambda x: x.isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"), found.alias("found"))
    joined = rows.join(F.broadcast(table), "digest", "left")
    return joined.select("doc_id", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"), "digest")
