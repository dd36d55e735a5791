"""Language identification by word-first backoff.

Training counts, per language, whole words and character n-grams (1 to
``MAX_GRAM``, with word-boundary marks) of labelled texts.  A word that the
model knows scores by its per-language log frequency.  An unseen word falls
back to its longest character n-grams: at the first length where the model
knows any, the word scores by the mean log frequency of those; a word without
any known n-gram says nothing.  A text's language has the largest sum over its
words.  The score is that language's share in a softmax over the sums, with the
evidence of a text tempered to at most ``EVIDENCE`` words, so that long texts don't
all score 1.

The model is fitted on a bounded sample of labelled rows (``TRAIN_DOCS`` per
language, chosen by a hash of the id) and keeps, of every language, the ``MAX_TERMS``
most frequent words and as many n-grams of each length, so that it may be broadcast and
no language crowds out another; prediction covers every text.

Rows: a null text, or one without a letter, is ``und`` with score 0.  Without
any training row everything is ``und``.  Equal scores go to the first language in
code point order.  Results are per row: repeated rows give repeated results and
an empty table an empty one.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import held_out, small_batches

UNKNOWN = "und"
TRAIN_DOCS = 4_000
MAX_GRAM = 5
MAX_TERMS = 8_000
SMOOTHING = 0.5
EVIDENCE = 10.0
CACHE_TOKENS = 300_000
FLUSH_TERMS = 400_000


def _class(*kinds: str) -> str:
    """Regex class items of all characters whose Unicode category starts with one of ``kinds``."""
    found = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith(kinds)]
    breaks = [i for i in range(1, len(found)) if found[i] != found[i - 1] + 1]
    runs = zip([0, *breaks], [*breaks, len(found)])
    return "".join(f"{chr(found[s])}-{chr(found[e - 1])}" for s, e in runs)


#: A word: a letter, then letters and the marks that combine with them (number characters are no letters).
_LETTERS, _MARKS = _class("L"), _class("M")
_WORD = re.compile(f"[{_LETTERS}][{_LETTERS}{_MARKS}]*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the marked word; single characters are taken without marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model(NamedTuple):
    langs: list[str]
    row: dict[tuple[int, str], int]  # (n, term) -> row of logs; n is 0 for words
    logs: np.ndarray


def build_model(counts: list[tuple[int, str, str, int]]) -> Model:
    """``counts``: (n, term, language, count); frequencies are relative to the language's terms of that n."""
    langs = sorted({c[2] for c in counts})
    at = {lang: i for i, lang in enumerate(langs)}
    row: dict[tuple[int, str], int] = {}
    for n, term, _, _ in counts:
        row.setdefault((n, term), len(row))
    table = np.zeros((len(row), len(langs)))
    size = np.array([n for n, _ in row], np.int64)
    for n, term, lang, count in counts:
        table[row[n, term], at[lang]] += count
    logs = np.zeros_like(table)
    for n in np.unique(size):
        own = table[size == n]
        logs[size == n] = np.log(own + SMOOTHING) - np.log(own.sum(0) + SMOOTHING * len(own))
    return Model(langs, row, logs)


class Scorer:
    """Scores texts; remembers the vectors of up to ``CACHE_TOKENS`` tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: list[dict[str, int]] = [{} for _ in range(MAX_GRAM + 1)]  # by n, 0 for words
        for (n, term), at in model.row.items():
            self.rows[n][term] = at
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}  # token -> row
        self.words: dict[str, int] = {}  # word -> row
        self.table, self.used = np.zeros((1 << 12, len(self.model.langs) + 1)), 0  # doubled when full

    def word(self, word: str) -> np.ndarray:
        logs = self.model.logs
        at = self.rows[0].get(word)
        if at is not None:
            return logs[at]
        for n in range(MAX_GRAM, 0, -1):
            known = self.rows[n]
            rows = [known[g] for g in grams(word, n) if g in known]
            if rows:
                return np.add.reduce(logs[rows], 0) / len(rows)
        return np.zeros(len(self.model.langs))

    def _add(self, vector: np.ndarray, n_words: int) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        self.table[self.used, :-1], self.table[self.used, -1] = vector, n_words
        self.used += 1
        return self.used - 1

    def _word_row(self, word: str) -> int:
        at = self.words.get(word)
        if at is None:
            at = self.words[word] = self._add(self.word(word), 1)
        return at

    def _token_row(self, token: str) -> int:
        """Row of the sums over the token's words; the last column counts them."""
        own = [self._word_row(w) for w in _WORD.findall(token)]
        return own[0] if len(own) == 1 else self._add(self.table[own, :-1].sum(0), len(own))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.known) > CACHE_TOKENS:
            self._reset()
        known = self.known
        rows = []
        for text in texts:
            row = []
            for token in (text or "").lower().split():
                at = known.get(token)
                if at is None:
                    at = known[token] = self._token_row(token)
                row.append(at)
            rows.append(row)
        return [self._decide(self.table[row].sum(0) if row else None) for row in rows]

    def _decide(self, sums: np.ndarray | None) -> tuple[str, float]:
        if sums is None or not sums[-1] or not self.model.langs:
            return UNKNOWN, 0.0
        logits = sums[:-1] * min(1.0, EVIDENCE / sums[-1])
        best = int(np.argmax(logits))
        return self.model.langs[best], float(1 / np.exp(logits - logits[best]).sum())


def training_sample(labelled: DataFrame, key: str, lang: str, per_lang: int) -> DataFrame:
    """About ``per_lang`` rows of each language (all, if fewer), by a hash of the id."""
    rates = labelled.groupBy(lang).count().select(
        F.col(lang).alias("_lang"), F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("count")).alias("_rate"))
    u = F.pmod(F.xxhash64(F.lit("langid"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(F.broadcast(rates), labelled[lang] == rates["_lang"]).where(u < F.col("_rate")).select(labelled.columns)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = TRAIN_DOCS, max_terms: int = MAX_TERMS) -> Model:
    """Count words and n-grams of the sample on the executors; only the kept terms reach the driver."""
    small_batches(docs.sparkSession)
    labelled = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_l")) \
        .where(F.col("_l").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id")))
    sample = training_sample(labelled, "_id", "_l", per_lang).select("_l", "_text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        per: dict[str, Counter] = {}

        def flush() -> pd.DataFrame:
            rows = []
            for lang_of, seen in per.items():
                total: Counter = Counter()
                for w, c in seen.items():
                    total[0, w] += c
                    for n in range(1, MAX_GRAM + 1):
                        for g in grams(w, n):
                            total[n, g] += c
                rows += [(n, t, lang_of, c) for (n, t), c in total.items()]
            per.clear()
            return pd.DataFrame(rows, columns=["n", "term", "lang", "count"])

        for batch in batches:
            for lang_of, t in zip(batch["_l"], batch["_text"]):
                per.setdefault(lang_of, Counter()).update(words(t))
            if sum(map(len, per.values())) > FLUSH_TERMS:
                yield flush()
        yield flush()

    parts = sample.mapInPandas(count, "n int, term string, lang string, count long")
    counts = parts.groupBy("n", "term", "lang").agg(F.sum("count").alias("count"))
    place = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "term"))
    terms = counts.withColumn("place", place).groupBy("n", "term").agg(
        F.collect_list(F.struct("lang", "count")).alias("langs"), F.min("place").alias("place"))
    kept = terms.where(F.col("place") <= max_terms)  # at most max_terms for each language and n
    rows = kept.select("n", "term", F.inline("langs")).orderBy("n", "term", "lang").toArrow()
    return build_model(list(zip(*(rows.column(c).to_pylist() for c in ("n", "term", "lang", "count")))))


#: The scorer of the last model that this Python worker has met.
_SCORERS: dict[str, Scorer] = {}


def predictor(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Text column -> struct(lang_pred, score); the model goes out once as a broadcast variable."""
    small_batches(spark)
    shared, name = spark.sparkContext.broadcast(tuple(model)), uuid.uuid4().hex

    @pandas_udf("struct<lang_pred:string,score:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(Model(*shared.value))
        return pd.DataFrame(_SCORERS[name].predict(texts.tolist()), columns=["lang_pred", "score"])

    return run


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit on the labelled rows that aren't held out, then predict every row."""
    judge = predictor(docs.sparkSession, fit(docs, key, text, lang))
    out = docs.select(F.col(key).alias("_key"), judge(F.col(text)).alias("_judged"))
    return out.select(F.col("_key").alias(key), held_out(F.col("_key")).alias("held_out"), "_judged.lang_pred", "_judged.score")
