"""Licence scan by canonical digest.

A text is normalised (case, punctuation, copyright lines, equivalent spellings,
white space) and its SHA-256 is joined with the digests of known licence texts,
normalised the same way: an entire text is one of the known texts or it is not.
SQL functions only.

Beside the whole text, the licence notices inside longer documents are looked up
the same way: every line (``\\n``-split) is a text of its own, so a document that
carries a known one-line notice is found too.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import ascii_lower

# Texts of public licences and common notices, by SPDX name.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
}

KNOWN["BSD-3-Clause"] = KNOWN["BSD-2-Clause"].replace(
    "\n\nTHIS SOFTWARE", "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE")
KNOWN |= {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}

# Title lines that stand over a text or not, and how many of a stored text's first lines are titles.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The 2-Clause BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The 3-Clause BSD License",
                     "BSD License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
TITLE_LINES = {"Apache-2.0": 3, "GPL-2.0": 2, "GPL-3.0": 2, "LGPL-2.1": 2, "LGPL-3.0": 2, "MPL-1.1": 2, "MPL-2.0": 1,
               "CC0-1.0": 2, "BSL-1.0": 1}
_END = "END OF TERMS AND CONDITIONS"  # an appendix follows, which many copies leave out

#: Known texts that a scan takes at most.
MAX_KNOWN = 10_000

# Spellings that count as one, after case and punctuation are gone.
EQUIVALENT = (
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("sublicence", "sublicense"), ("sub licence", "sublicense"), ("organisation", "organization"),
    ("authorised", "authorized"), ("judgement", "judgment"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("and or", "or"), ("favour", "favor"), ("https", "http"),
)

_COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*"


def canonical(text: Column) -> Column:
    """``text`` (null: empty) in lower case without copyright lines, punctuation
    and doubled white space, its words in one spelling.

    Case is folded for A-Z only, and punctuation is whatever is neither a letter
    or digit of ASCII nor beyond ASCII, so that every engine agrees.
    """
    out = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                      "abcdefghijklmnopqrstuvwxyz")
    out = F.regexp_replace(out, _COPYRIGHT_LINE, "$1")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[^a-z0-9\x{80}-\x{10FFFF}]+", " "), F.lit(" "))
    for other, chosen in EQUIVALENT:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {chosen} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form as lower-case hex."""
    return F.sha2(canonical(text).cast("binary"), 256)


def _canonical(text: str) -> str:
    """``canonical`` of a known text, in Python."""
    out = re.sub(_COPYRIGHT_LINE, r"\1", ascii_lower(text))
    out = f" {re.sub('[^a-z0-9\x80-\U0010ffff]+', ' ', out)} "
    for other, chosen in EQUIVALENT:
        out = out.replace(f" {other} ", f" {chosen} ")
    return re.sub(" +", " ", out).strip(" ")


def known_texts() -> list[tuple[str, str]]:
    """(name, text) of KNOWN, each as its copies stand: with and without title
    lines, appendix, line breaks and (BSD) numbers of the conditions."""
    out: dict[tuple[str, str], str] = {}
    for name, text in KNOWN.items():
        forms = [text]
        if name.startswith("BSD-"):
            forms.append(re.sub(r"(?m)^\d\. ", "* ", text))
        forms += [f[:f.index(_END) + len(_END)] for f in forms if _END in f]
        forms += [f"{title}\n\n{f}" for f in forms for title in TITLES.get(name, ())]
        for f in list(forms):
            for _ in range(TITLE_LINES.get(name, 0)):
                f = f.lstrip().partition("\n")[2]
                forms.append(f)
        forms += [re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", f) for f in forms]
        for f in forms:
            out.setdefault((name, _canonical(f)), f)
    return sorted((name, f) for (name, _), f in out.items())


def _spellings(word: str) -> str:
    """A pattern of what a word of a canonical text can be in the text itself."""
    out = [word]
    for other, chosen in EQUIVALENT:
        if word in chosen.split() and word not in other.split():
            out.append("[^a-z0-9]+".join(_spellings(w) for w in other.split()))
    return out[0] if len(out) == 1 else f"({'|'.join(out)})"


def line_filter(texts: list[str]) -> str:
    """A pattern that is found in every line whose canonical form is that of one of
    ``texts``: each text has one of its words, few words in all and long ones."""
    left = [set(_canonical(t).split()) for t in texts]
    chosen = []
    while left:
        if not all(left):
            return ""
        count: dict[str, int] = {}
        for words in left:
            for w in [w for w in words if len(w) >= 7] or [max(words, key=lambda w: (len(w), w))]:
                count[w] = count.get(w, 0) + 1
        best = max(count, key=lambda w: (count[w], len(w), w))
        chosen.append(best)
        left = [words for words in left if best not in words]
    return "(?i)" + "|".join(_spellings(w) for w in chosen) if chosen else ""


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """(license, license_digest), one row per known text; several names of one
    canonical text give the smallest."""
    rows = spark.createDataFrame(known_texts() if known is None else sorted(known.items()), "license string, text string")
    return (rows.select("license", digest(F.col("text")).alias("license_digest"))
            .groupBy("license_digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame | dict[str, str] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, canonical_digest, license, n_notices, notices) per row of ``docs``.

    license names the known text that the whole document is (null: none);
    notices lists, sorted, the known texts among its lines, n_notices counts the
    lines.  Null texts count as empty, which is no licence.  Repeated rows give
    repeated results; other columns play no part.

    The known digests are a list that the caller sets, of MAX_KNOWN texts at most
    (more raise a ValueError): about 100 bytes each, so that the join broadcasts them
    and no text is moved.  Given as texts by name (None: ``known_texts``), lines are
    looked up only if they have a word that every such line must have; given as
    ``known_digests`` alone, every line is.
    """
    spark = docs.sparkSession
    hint = ""
    if not isinstance(known, DataFrame):
        hint = _HINT if known is None else line_filter(list(known.values()))
        known = known_digests(spark, known)
    # one map from digest to name: bounded by the known texts, not by the documents
    names = {r.license_digest: r.license for r in known.limit(MAX_KNOWN + 1).collect()}
    if len(names) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known licence texts")
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    whole = (narrow.select("doc_id", "text", digest(F.col("text")).alias("canonical_digest"))
             .join(F.broadcast(known), F.col("canonical_digest") == F.col("license_digest"), "left")
             .drop("license_digest"))
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1),
                     lambda x: F.rlike(x, F.lit(hint)))
    return (whole.withColumn("lines", lines)
            .withColumn("found", F.filter(F.transform("lines", lambda x: table[digest(x)]),
                                          lambda x: x.isNotNull()))
            .select("doc_id", "canonical_digest", "license", F.size("found").cast("long").alias("n_notices"),
                    F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices")))


_HINT = line_filter([text for _, text in known_texts()])


def _oracle() -> str:
    """The same steps as DuckDB SQL, for documents with distinct ids."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        out = f"translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        out = f"regexp_replace({out}, {q(_COPYRIGHT_LINE)}, '\\1', 'g')"
        out = f"' ' || regexp_replace({out}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g') || ' '"
        for other, chosen in EQUIVALENT:
            out = f"replace({out}, {q(f' {other} ')}, {q(f' {chosen} ')})"
        return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"

    known = ", ".join(f"({q(k)}, {q(v)})" for k, v in known_texts())
    return f"""
WITH known AS (SELECT sha256({canon('t')}) AS d, min(k) AS license FROM (VALUES {known}) v(k, t) GROUP BY 1),
docs AS (SELECT doc_id, text FROM documents),
found AS (SELECT d.doc_id, l.license FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs) d
          JOIN known l ON l.d = sha256({canon('d.line')}) WHERE regexp_matches(d.line, {q(_HINT)})),
per AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM found GROUP BY doc_id)
SELECT docs.doc_id, sha256({canon('docs.text')}) AS canonical_digest, known.license,
       coalesce(per.n, 0) AS n_notices, coalesce(per.notices, '') AS notices
FROM docs LEFT JOIN known ON known.d = sha256({canon('docs.text')}) LEFT JOIN per USING (doc_id)
"""


ORACLE_SQL = _oracle()
