r"""Secret scan: key patterns, plus runs that a battery of randomness tests can't tell from noise.

Base kinds (leftmost non-overlapping per kind, failing matches dropped):

* ``assign``: ``(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)``, the
  keyword in either case of ASCII letters, the value of at least 12 characters;
* ``access``: ``AKIA[A-Z0-9]+`` of at least 18 characters;
* ``hex``: ``[0-9a-f]+`` of at least 16 characters.

The battery adds kind ``random``: runs of ``[A-Za-z0-9+/_-]`` that touch no base span.  The encoding is the
smallest alphabet that holds the run.  A run that mixes ``+ /`` with ``- _`` (a key in a path or after a name with
hyphens) is cut at either pair; of overlapping pieces the longest is judged.  Tests of "every symbol is drawn evenly and independently" follow:
chi-squared over the alphabet and over its character classes, Wald-Wolfowitz runs around the alphabet's middle, and
lag-1 serial correlation.  A run's p-value is the Bonferroni minimum of the four.  All runs of a text are judged together by the
Benjamini-Hochberg step-up with weights in proportion to the run's length (a longer run has more power), at
false-discovery rate ``FDR``: a run whose randomness is rejected is ordinary text.  Length-aware: a run counts
only if it is long enough for its alphabet that text would be rejected (``ENCODINGS``), and if it shows every
character class of its alphabet.

Rows: a null text is an empty text and has no spans.  Results are per row, so repeated rows give repeated
results and an empty table an empty one.  Offsets are code points of the whole text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import small_batches

KINDS = ("assign", "access", "hex", "random")
FDR = 0.02
MARK = "[SECRET]"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_SLASHES, _DASHES = re.compile(r"[+/]"), re.compile(r"[_-]")
_NO_SLASHES, _NO_DASHES = re.compile(r"[A-Za-z0-9_-]{20,}"), re.compile(r"[A-Za-z0-9+/]{20,}")
_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (symbols, character classes that must occur, least length), smallest alphabet first.
ENCODINGS = (
    (_DIGITS + _LOW[:6], (_DIGITS, _LOW), 24),
    (_DIGITS + _UP[:6], (_DIGITS, _UP), 24),
    (_UP + _DIGITS[2:8], (_DIGITS, _UP), 26),
    (_DIGITS + _LOW, (_DIGITS, _LOW), 32),
    (_DIGITS + _UP, (_DIGITS, _UP), 32),
    (_UP + _LOW + _DIGITS, (_DIGITS, _LOW, _UP), 20),
    (_UP + _LOW + _DIGITS + "+/", (_DIGITS, _LOW, _UP), 20),
    (_UP + _LOW + _DIGITS + "-_", (_DIGITS, _LOW, _UP), 20),
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans.  ``{n,}`` in a greedy class finds the same spans as ``+`` and a length test after it."""
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return spans


def infer_encoding(run: str) -> tuple[str, int] | None:
    """(alphabet, least length) of the smallest alphabet that holds ``run`` and whose classes all occur in it."""
    symbols = set(run)
    for alphabet, classes, least in ENCODINGS:
        if symbols <= set(alphabet) and all(symbols & set(c) for c in classes):
            return alphabet, least
    return None


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity_p(values: list[int], size: int) -> float:
    """Chi-squared test that all ``size`` symbols are equally likely (Wilson-Hilferty tail)."""
    expected, df = len(values) / size, size - 1
    counts = Counter(values)
    x = sum((c - expected) ** 2 for c in counts.values()) / expected + (size - len(counts)) * expected
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return _upper_normal(z)


def classes_p(run: str, alphabet: str) -> float:
    """Chi-squared test that digits, small and capital letters take the alphabet's shares: uniformity on a coarser
    scale, which has power where a run is short for its alphabet."""
    shares = [len(set(c) & set(alphabet)) / len(alphabet) for c in (_DIGITS, _LOW, _UP)]
    seen = [sum(map(c.__contains__, run)) for c in (_DIGITS, _LOW, _UP)]
    used = [(o, s * len(run)) for o, s in zip(seen, shares) if s]
    x, df = sum((o - e) ** 2 / e for o, e in used), len(used) - 1
    return math.exp(-x / 2) if df == 2 else math.erfc(math.sqrt(x / 2))


def runs_p(values: list[int], size: int) -> float:
    """Wald-Wolfowitz test around the middle of the alphabet, two-sided."""
    side = [v * 2 >= size for v in values]
    above = sum(side)
    below, n = len(side) - above, len(side)
    if not above or not below:
        return 2.0 ** (1 - n)
    mean = 2 * above * below / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(a != b for a, b in zip(side, side[1:]))
    return 2 * _upper_normal(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Lag-1 serial correlation, two-sided normal approximation."""
    n = len(values)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values)
    if var == 0:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / var
    return 2 * _upper_normal(abs(r + 1 / n) * math.sqrt(n))


def randomness_p(run: str, alphabet: str) -> float:
    """Bonferroni minimum over the battery: the smaller, the less the run looks evenly and independently drawn."""
    at = {c: i for i, c in enumerate(alphabet)}
    values = [at[c] for c in run]
    return min(1.0, 4 * min(uniformity_p(values, len(alphabet)), classes_p(run, alphabet), runs_p(values, len(alphabet)),
                            serial_p(values)))


def rejected(p: list[float], lengths: list[int], fdr: float = FDR) -> list[bool]:
    """Weighted Benjamini-Hochberg step-up; weights follow the lengths and average 1."""
    n, total = len(p), sum(lengths)
    scaled = [x * total / (n * w) for x, w in zip(p, lengths)]
    order = sorted(range(n), key=scaled.__getitem__)
    last = max((k for k, i in enumerate(order, 1) if scaled[i] <= fdr * k / n), default=0)
    out = [False] * n
    for i in order[:last]:
        out[i] = True
    return out


def pieces(run: str) -> list[tuple[int, str]]:
    """(start, piece) of what is judged of a run: the run, or its longest pieces that don't mix ``+ /`` with ``- _``."""
    if not (_SLASHES.search(run) and _DASHES.search(run)):
        return [(0, run)]
    cut = {(m.start(), m.group()) for part in (_NO_SLASHES, _NO_DASHES) for m in part.finditer(run) if infer_encoding(m.group())}
    kept: list[tuple[int, str]] = []
    for s, piece in sorted(cut, key=lambda x: (-len(x[1]), x[0])):
        at = bisect(kept, (s, ""))
        if (at == 0 or kept[at - 1][0] + len(kept[at - 1][1]) <= s) and (at == len(kept) or s + len(piece) <= kept[at][0]):
            kept.insert(at, (s, piece))
    return kept


def random_spans(text: str, base: list[tuple[str, int, int]], fdr: float = FDR) -> list[tuple[str, int, int]]:
    found = []
    for m in _RUN.finditer(text):
        for at, run in pieces(m.group()):
            start, end = m.start() + at, m.start() + at + len(run)
            if (kind := infer_encoding(run)) and not any(s < end and start < e for _, s, e in base):
                found.append((start, end, run, *kind))
    if not found:
        return []
    drop = rejected([randomness_p(r, a) for _, _, r, a, _ in found], [len(f[2]) for f in found], fdr)
    return [("random", s, e) for (s, e, r, _, least), no in zip(found, drop) if not no and len(r) >= least]


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def all_spans(text: str | None, fdr: float = FDR) -> list[tuple[str, int, int]]:
    """Every span of a text, by start and then by kind."""
    text = text or ""
    base = base_spans(text)
    return in_order(base + random_spans(text, base, fdr))


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """``key, spans``: an array of (kind, start, end) for every row."""
    small_batches(df.sparkSession)

    @pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in all_spans(t, fdr)] for t in texts],
                         dtype="object")

    return df.select(df[key].alias(key), spans(df[text]).alias("spans"))


def redact_text(text: str | None, fdr: float = FDR, mark: str = MARK) -> str | None:
    """The text with every covered stretch replaced (touching or overlapping spans become one)."""
    spans = sorted((s, e) for _, s, e in all_spans(text, fdr))
    if not spans:
        return text
    parts, at, upto = [], 0, -1
    for s, e in spans:
        if s > upto:
            parts += [text[at:s], mark]
        upto = at = max(upto, e)
    return "".join([*parts, text[at:]])


def redactor(spark: SparkSession, fdr: float = FDR, mark: str = MARK) -> Callable[[Column], Column]:
    """Text column -> redacted text column; a null stays null."""
    small_batches(spark)

    @pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t, fdr, mark) for t in texts], dtype="object")

    return run


def secret_digest(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's columns, derived from the operator's spans."""
    found = scan_secrets(df, key, text)
    kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    text_of = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        key, kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"),
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"),
        kind("random").alias("n_random"),
    )
