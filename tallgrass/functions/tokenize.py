"""The three tokenizers of the reference, as native column expressions.

They disagree on purpose (case, punctuation, empty words), so each keeps its
own rule. Callers ``explode`` the split text, so the token stream stays
distributed and the count after it gets a map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Java.util.StringTokenizer default delimiters: space, tab, newline, carriage return, form feed.
WS_DELIMS_REGEX = "[ \t\n\r\f]+"
# Java "\W+" (ASCII non-word characters) after lower-casing.
NONWORD_REGEX = "\\W+"
# Characters Python's str.strip removes at both ends in the word-count cell.
STRIP_CHARS = ".,;:?!-"
# Python str.split() with no argument splits on every character for which
# str.isspace() is true: tab, LF, VT, FF, CR, 0x1C-0x1F, space, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE_REGEX = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\u0085\\u00A0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000]+"
)


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


# Row-stream form used by the word counts: (raw split array, per-token map
# applied after the empty pieces are filtered). Filtering and mapping after
# the explode keeps the work in whole-stage codegen instead of array lambdas.
SPLITTERS = {
    "ws": (lambda t: F.split(_col(t), WS_DELIMS_REGEX), lambda w: w),
    "nonword": (lambda t: F.split(F.lower(_col(t)), NONWORD_REGEX), lambda w: w),
    "strip": (lambda t: F.split(_col(t), PY_WHITESPACE_REGEX), lambda w: F.btrim(w, F.lit(STRIP_CHARS))),
}
