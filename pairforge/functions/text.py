"""String helpers: Python-compatible strip, prompt-echo removal, whitespace tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's ``str.strip()`` removes (``str.isspace``):
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.  Spark's ``trim`` removes only U+0020.
PY_WHITESPACE = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

# Separator of the default whitespace tokeniser (same class in Java regex and RE2).
TOKEN_SEPARATOR = "[ \t\n\r]+"

_MAX_INT = 2**31 - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Last UTF-8 byte of each whitespace code point (derived from the set above).
_WS_LAST_BYTES = sorted({ch.encode("utf-8")[-1] for ch in PY_WHITESPACE})


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: trim every Unicode whitespace code point from both ends.

    ``btrim`` with an explicit set walks and allocates per character, and a
    negative ``substring`` counts characters over the whole string; so the
    exact trim only runs when the first character is whitespace or the last
    *byte* could end a whitespace code point (an O(1) superset test on the
    binary view).
    """
    s = _col(c)
    first_ws = F.substring(s, 1, 1).isin(*PY_WHITESPACE)
    last_ws = F.substring(s.cast("binary"), -1, 1).isin(*[F.lit(bytes([b])) for b in _WS_LAST_BYTES])
    return F.when(first_ws | last_ws, F.btrim(s, F.lit(PY_WHITESPACE))).otherwise(s)


def strip_echo(text: Column | str, prompt: Column | str) -> Column:
    """Drop the first ``length(prompt)`` characters of ``text`` without checking them.

    A text shorter than the prompt gives ``""`` (Python slice semantics).
    """
    return _col(text).substr(F.length(_col(prompt)) + 1, F.lit(_MAX_INT))


def drop_chars(text: Column | str, n: Column) -> Column:
    """P6 when only the prompt's length is at hand: drop the first ``n`` characters."""
    return _col(text).substr(n + 1, F.lit(_MAX_INT))


def strip_echo_all(texts: Column | str, prompt: Column | str) -> Column:
    """``strip_echo`` applied to every element of an array of returned texts."""
    p = _col(prompt)
    return F.transform(_col(texts), lambda t: strip_echo(t, p))


def whitespace_pieces(text: Column | str) -> Column:
    """Default tokeniser: non-empty pieces between runs of ASCII whitespace."""
    return F.filter(F.split(_col(text), TOKEN_SEPARATOR), lambda x: x != F.lit(""))


def piece_id(piece: Column) -> Column:
    """Deterministic integer id of a piece: the first 24 bits of its MD5."""
    return F.conv(F.substring(F.md5(piece), 1, 6), 16, 10).cast("long")


def token_ids(text: Column | str) -> Column:
    """array<long> of piece ids for ``text`` (the default tokeniser hook)."""
    return F.transform(whitespace_pieces(text), piece_id)
