"""Tokenising CSV-like lines with built-in array functions.

The quoted-field rule: a token is a run of characters that are neither a
comma nor a quote, or quoted sections that may contain commas.  Unquoted
empty fields produce no token (``a,,b`` -> 2 tokens), a trailing comma
produces none, quoted empties are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the token pattern of the source format, written with possessive
# quantifiers.  Java's regex engine recurses on the plain form and overflows
# its stack on a field of ~30,000 characters; the possessive form does not
# backtrack and gives the same tokens on well-formed lines.
QUOTED_TOKEN_PATTERN_POSSESSIVE = r'(?:[^,"]|"[^"\\]*+(?:\\.[^"\\]*+)*+")++'

# CSV fields, empty ones kept, of a line with a comma put in front: each match
# starts at a separating comma and captures the field (runs of non-comma
# characters, quoted sections, a quote that is never closed; possessive so a
# long field cannot backtrack).
CSV_FIELD_PATTERN = r',((?:[^,"]++|"[^"]*+"|")*+)'

# Outer whitespace as Python's str.strip sees it (Unicode white space and
# the four ASCII separator controls).
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_quoted(c: ColumnOrName, keep_empty: bool = False) -> Column:
    """Line -> array of raw tokens, quotes still in place.

    By default unquoted empty fields give no token, as in the source rule;
    ``keep_empty=True`` keeps every field in its position (CSV semantics:
    'a,,b' -> ['a', '', 'b'], a trailing comma adds an empty last field).
    """
    if keep_empty:
        return F.regexp_extract_all(F.concat(F.lit(","), _col(c)), F.lit(CSV_FIELD_PATTERN), 1)
    return F.regexp_extract_all(_col(c), F.lit(QUOTED_TOKEN_PATTERN_POSSESSIVE), 0)


def clean_token(x: Column) -> Column:
    """Remove every double quote, then outer whitespace."""
    return F.regexp_replace(F.replace(x, F.lit('"'), F.lit("")), _OUTER_SPACE, "")


def clean_tokens(arr: ColumnOrName) -> Column:
    """Apply :func:`clean_token` to each element of a token array."""
    return F.transform(_col(arr), clean_token)


def field_by_name(tokens: ColumnOrName, header: ColumnOrName, name: str) -> Column:
    """Token whose header entry equals ``name``; null when the name is not
    in the header or the row is shorter (F12)."""
    pos = F.array_position(_col(header), F.lit(name)).cast("int")
    return F.when(pos > 0, F.try_element_at(_col(tokens), pos))
