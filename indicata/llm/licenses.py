"""Licence scan by canonical digests (native DataFrame functions only).

A text is brought to a canonical form and its SHA-256 is looked up among the
digests of known licence texts and notices:

1. case: lower-cased;
2. copyright lines (starting with ``copyright``, ``(c)`` or the sign) go, but not lines of a clause that
   happens to be broken there (``COPYRIGHT HOLDERS BE LIABLE``);
3. punctuation and white space: each run becomes one space, lines without
   words go;
4. equivalent spellings (``SPELLINGS``, single words, and the -ise/-ize rule) are
   unified.

Whole texts are looked up (their lines joined by a space), and every line as a
text of its own, so a notice inside a document is found as well.  The table of known texts is
fixed (some tens of digests) and part of the plan, a hash table in every task: each row is judged by
itself, and nothing is shuffled.

Defined cases: a null text has a null digest and matches nothing; an empty text
or one of only punctuation has the digest of the empty string, which no known
text has; rows sharing an id, and rows without one, give a row each; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns of the canonical form.  A line is a copyright line if it matches a pattern of
# NOTICES and, from there on, none of what makes it a clause.  No look-around, so that SQL can say the same.
LEAD = r"^[ \t#*/;-]*"
_END = r"(?:[^a-z0-9_]|$)"  # of a word
_CLAUSE = (r"(?:holders?|owners?|notices?|laws?|licen[sc]es?|statements?|permissions?|treat(?:y|ies)|disclaimers?|interests?"
           r"|rights?|protections?|patents?|trademarks?|ownership|doctrines?|resulting|like|if|and|or|on|in|is|as|for|to|that|the[ \t]+(?:software|library|program))")
NOTICES = (
    (LEAD + "copyright" + _END, (LEAD + rf"copyright[ \t,-]*{_CLAUSE}{_END}", LEAD + r"copyright[ \t,.;-]*(?:the)?[ \t]*$")),
    (LEAD + r"\(c\)", (LEAD + rf"\(c\)[ \t]*(?:you|under|if|to|the|a|an|any|all|each|in|for|it|affirmer){_END}", LEAD + r"\(c\)[ \t]*$")),
    (LEAD + "©", ()),
)
SEPARATORS = r"[\x00-\x09\x0b-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\x{a0}\x{a9}\x{ab}\x{bb}\x{2010}-\x{2027}]+"
# Equivalent spellings of single words of the canonical form.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("sublicense", "sub license"),
    ("sublicence", "sub license"), ("sublicensed", "sub licensed"), ("acknowledgement", "acknowledgment"),
    ("whilst", "while"), ("wilful", "willful"), ("noninfringement", "non infringement"),
    ("noncommercial", "non commercial"), ("percent", "per cent"), ("https", "http"),
)
IZE = r"\b(authori|organi|recogni|utili|initiali|customi)s(e|ed|es|ing|ation|ations)\b"

# Known licence texts and notices.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("all-rights-reserved", "All rights reserved."),
)

_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer."""
_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_MAY = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""


def _bsd(clauses: tuple[str, ...], number: str) -> str:
    return "\n\n".join([_MAY, *(number.format(i + 1) + c for i, c in enumerate(clauses)), _AS_IS])


# Title lines that may stand before a text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     "BSD 2-Clause Simplified License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     "BSD 3-Clause New or Revised License"),
}


def complete_texts() -> tuple[tuple[str, str], ...]:
    """(license, text) of complete licences: with and without a title line, a line
    that reserves all rights, numbers before clauses, and what follows the terms."""
    texts = [(name, text) for name, text in KNOWN[:2]]
    texts += [("BSD-2-Clause", _bsd((_SOURCE, _BINARY), n)) for n in ("", "{}. ")]
    texts += [("BSD-3-Clause", _bsd((_SOURCE, _BINARY, _NAMES), n)) for n in ("", "{}. ")]
    out = [(name, "\n".join([*title, *rights, text])) for name, text in texts for title in ((), *((t,) for t in TITLES[name]))
           for rights in ((), ("All rights reserved.",))]
    end = "END OF TERMS AND CONDITIONS"
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out.append((path.stem, text))
        if end in text:
            out += [(path.stem, text.split(end)[0]), (path.stem, text.split(end)[0] + end)]
    return tuple(out)


def is_notice(line: Column) -> Column:
    """Whether a lower-case line is a copyright line."""
    found = F.lit(False)
    for begins, clauses in NOTICES:
        own = F.rlike(line, F.lit(begins))
        for c in clauses:
            own = own & ~F.rlike(line, F.lit(c))
        found = found | own
    return found


def canonical_lines(text: Column) -> Column:
    """array<string>: the canonical form of every line that has words."""
    kept = F.filter(F.split(F.lower(text), "\n", -1), lambda line: ~is_notice(line))
    out = F.concat(F.lit(" "), F.regexp_replace(F.array_join(kept, " \n "), SEPARATORS, " "), F.lit(" "))
    for spelled, unified in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelled} "), F.lit(f" {unified} "))
    lines = F.split(F.regexp_replace(out, IZE, "$1z$2"), "\n", -1)
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda line: line != "")


def _sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def known_digests(spark: SparkSession, known=None) -> dict[str, str]:
    """License by digest of the canonical text (a fixed list: some tens)."""
    rows = spark.createDataFrame(list(known or KNOWN + complete_texts()), "license string, text string")
    digest = _sha(F.array_join(canonical_lines(F.col("text")), " "))
    return dict(rows.groupBy(digest.alias("digest")).agg(F.min("license")).collect())


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, its text digest, the licence its whole text is
    (or null), the number of its lines that are known notices and their
    licences, sorted and joined by ``;`` (empty: none)."""
    table = known_digests(docs.sparkSession, known)
    found = F.create_map(*(F.lit(x) for item in sorted(table.items()) for x in item))
    lines = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col).cast("string")).alias("lines"))
    # The digests of a text and of its known lines, worked out once in a generator.
    known_lines = F.filter(F.transform("lines", _sha), lambda d: d.isin(list(table)))
    looked = lines.select("doc_id", F.inline(F.array(F.struct(
        _sha(F.array_join("lines", " ")).alias("text_digest"), F.coalesce(known_lines, F.array().cast("array<string>")).alias("hits")))))
    return looked.select(
        "doc_id", "text_digest", F.try_element_at(found, F.col("text_digest")).alias("license"),
        F.size("hits").cast("long").alias("n_notice_lines"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("hits", lambda d: F.try_element_at(found, d)))), ";")
        .alias("notice_licenses"))
