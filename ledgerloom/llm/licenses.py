"""License scans: canonical digests of whole texts, joined to the digests of known licences.

The canonical form puts A-Z in lower case, drops copyright and all-rights-reserved lines,
replaces equivalent spellings, turns every run of white space and ASCII punctuation into one
space and trims. Known texts take the same way, so their digests can be joined. A unit is
the whole document and each of its lines: a licence may be the document, or a notice may be
one of its lines.

Only SQL functions are used. The known digests are a fixed small table of the library; a
document's digest is joined to it by a broadcast hash join, its lines' digests are looked up
in the same table as a constant, so no text is shuffled.

Defined results: null, empty and purely copyright texts have the canonical form "" and match
nothing. Rows with the same doc_id are scanned one by one. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Wording that counts as the same, British or variant spelling first.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub-license", "sublicense"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("non-commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https:", "http:"),
)

# Notices of one line, by the identifier of the licence that they name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)

# Whole licences.
_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
LICENSES = (
    ("0BSD", f"{_PERMISSION}.\n\n{_AS_IS}"),
    ("ISC", f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_AS_IS}"),
    ("MIT", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")),
    ("Zlib", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software.\n3. This notice may not be removed or altered from any source "
        "distribution.")),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines dropped: copyright with a mark or a year, and reservations of rights.
DROPPED = r"(?m)^[^0-9a-z\n©(]*(copyright([ \t]*(\(c\)|©)|[^\n]*[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*$"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, empty ones left out."""
    text = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    text = F.regexp_replace(text, DROPPED, "")
    for other, one in EQUIVALENT:
        text = F.replace(text, F.lit(other), F.lit(one))
    lines = F.split(F.regexp_replace(text, PUNCTUATION, " "), "\n", -1)
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def known(spark: SparkSession) -> DataFrame:
    """license_id and digest of the library's texts, through the same canonical form."""
    texts = spark.createDataFrame([*LICENSES, *NOTICES], "license_id string, text string")
    lines = texts.withColumn("lines", canonical_lines(F.col("text")))
    return lines.select("license_id", F.sha2(F.array_join("lines", " "), 256).alias("digest"))


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, digest (of its canonical form), license_id (whole text), notices (ids of whole lines)."""
    spark = docs.sparkSession
    table = known(spark)
    rows = table.collect()  # a fixed number
    digests = F.array(*(F.lit(r.digest) for r in rows))
    names = F.create_map(*(F.lit(x) for d, i in sorted({(r.digest, r.license_id) for r in rows}) for x in (d, i)))
    lines = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    units = lines.select(
        "doc_id", F.sha2(F.array_join("lines", " "), 256).alias("digest"),
        F.array_intersect(F.transform("lines", lambda x: F.sha2(x, 256)), digests).alias("found"))
    whole = units.join(F.broadcast(table.dropDuplicates(["digest"])), "digest", "left")
    return whole.select(
        "doc_id", "digest", "license_id",
        F.array_sort(F.array_distinct(F.transform("found", lambda d: names[d]))).alias("notices"))
