"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Labelled rows teach three things, all on a bounded sample (``TRAIN_ROWS`` per label, by a hash of the id):

* the vocabulary: every word of the sample, with its idf times ``FLOOR`` + what it tells about the label (the log odds
  ratio of its presence, less ``DOUBT`` standard errors, at least 0).  Ordinary words weigh little, but every
  word counts, so every text that shares a word with an example has neighbours;
* the examples: TF-IDF vectors over that vocabulary, in an inverted index in blocks of ``BLOCK`` examples with the
  largest weight of every term in every block it occurs in;
* the calibration: isotonic regression of the labels on leave-one-out votes.

The sample's words and vectors pass through the driver once; their size is bounded by the sample's texts, whatever
the size of the table.

A label of more than ``TRAIN_ROWS`` rows is sampled, so an example counts as many rows as it stands for: all rows of its
label / sampled ones (1 below the cap).  Votes, calibration, overall rate and idf use these weights, so scores
follow the labels' real shares at every size.  Only the log odds ratios, which do not depend on the shares, use
plain counts.

A text's neighbours are the ``K`` examples of the highest cosine: the blocks of the highest upper bounds (the text's
weights times the block maxima) are opened first, and then every block whose bound reaches the K-th cosine so far, so
neighbours are exact.  They vote with the weight of their label / (distance + ``SOFTEN``); the calibrated vote is the score, the
neighbours are the evidence.  A text without any word of the vocabulary has no neighbours and gets the rate of such
examples.

Rows: a null text is an empty text.  Rows without a label (or with a null one) teach nothing; if an id is labelled
twice, the larger label counts.  Without labels of both kinds the score is the label's overall rate (0 without any).
Equal similarities go to the smaller example number.  Results are per row: repeated rows give repeated
results and an empty table an empty one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small_batches, written

TRAIN_ROWS = 1_000
FLOOR = 0.05
DOUBT = 2.0
BLOCK = 64
FIRST_BLOCKS = 2
K = 15
SOFTEN = 0.05
PRIOR_WEIGHT = 1.0
THRESHOLD = 0.7
CACHE_TOKENS = 300_000
FLUSH_TERMS = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def telling(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """What each word's presence tells about the label: |log odds ratio| less ``DOUBT`` standard errors, at least 0.
    A lower bound of an effect does not grow with the sample as a test statistic does."""
    cells = [with_toxic + 0.5, toxic - with_toxic + 0.5, with_clean + 0.5, clean - with_clean + 0.5]
    odds = np.log(cells[0] * cells[3] / (cells[1] * cells[2]))
    return np.maximum(np.abs(odds) - DOUBT * np.sqrt(sum(1 / c for c in cells)), 0.0)


class Vectorizer:
    """Texts to unit TF-IDF vectors over the vocabulary."""

    def __init__(self, idf: dict[str, float]):
        self.at = {t: i for i, t in enumerate(idf)}
        self.idf = np.array(list(idf.values()))
        self.known: dict[str, tuple[int, ...]] = {}

    def _hits(self, token: str) -> tuple[int, ...]:
        if len(self.known) > CACHE_TOKENS:
            self.known.clear()
        self.known[token] = hits = tuple(i for t in _WORD.findall(token) if (i := self.at.get(t)) is not None)
        return hits

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights); empty if the text has no term of the vocabulary."""
        found: list[int] = []
        get = self.known.get
        for token in (text or "").lower().split():
            hits = get(token)
            found += self._hits(token) if hits is None else hits
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        terms, counts = np.unique(np.array(found, np.int64), return_counts=True)
        w = (1 + np.log(counts)) * self.idf[terms]
        return terms, w / np.sqrt((w ** 2).sum())


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the ranges start..stop, one after the other, and the range each belongs to)"""
    n = stop - start
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + (start - np.concatenate(([0], np.cumsum(n)[:-1])))[of], of


class BlockMaxIndex:
    """Inverted index of unit vectors.  A term's postings are cut at block bounds; each such segment knows its
    block and its largest weight."""

    def __init__(self, n_terms: int, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        ex = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((ex, term))
        self.ex, self.weight, term = ex[order], weight[order], term[order]
        block = self.ex // BLOCK
        new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(term) else [])
        self.first = np.concatenate((new, [len(term)])).astype(np.int64)  # postings of segment s: first[s] to first[s + 1]
        self.block = block[new]
        self.max = np.maximum.reduceat(self.weight, new) if len(new) else np.zeros(0)
        self.start = np.searchsorted(term[new], np.arange(n_terms + 1))  # segments of term t: start[t] to start[t + 1]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """(examples, cosines) of the k nearest with a positive cosine, and the number of opened blocks.

        The blocks of the highest bounds are opened first; their k-th cosine then tells which others can matter."""
        segment, of = _spread(self.start[terms], self.start[terms + 1])
        weight, block = weights[of], self.block[segment]
        bound = np.bincount(block, weight * self.max[segment], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]

        def cosines(blocks: np.ndarray) -> np.ndarray:
            if 4 * len(blocks) > self.blocks:  # whole lists are cheaper than many of their segments
                start, stop = self.first[self.start[terms]], self.first[self.start[terms + 1]]
                lists = list(map(slice, start.tolist(), stop.tolist()))
                ex, w = np.concatenate([self.ex[x] for x in lists]), np.concatenate([self.weight[x] for x in lists])
                w *= np.repeat(weights, stop - start)
            else:
                chosen = np.zeros(self.blocks, bool)
                chosen[blocks] = True
                own = np.flatnonzero(chosen[block])
                posting, at = _spread(self.first[segment[own]], self.first[segment[own] + 1])
                ex, w = self.ex[posting], weight[own][at] * self.weight[posting]
            cos = np.bincount(ex, w, self.n)
            if leave >= 0:
                cos[leave] = 0
            return cos

        cos = cosines(order[:FIRST_BLOCKS])
        found = cos[cos > 0]
        least = np.partition(found, len(found) - k)[len(found) - k] if len(found) >= k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[bound[rest] >= least - 1e-9]
        if 4 * len(rest) > self.blocks:
            cos = cosines(order)
        elif len(rest):
            cos = cos + cosines(rest)
        exact = np.round(cos, 12)
        least = np.partition(exact, self.n - k)[self.n - k] if self.n > k else 0.0
        near = np.flatnonzero((exact > 0) & (exact >= least))
        best = near[np.lexsort((near, -exact[near]))[:k]]
        return best, exact[best], len(order[:FIRST_BLOCKS]) + len(rest)


def vote(cosines: np.ndarray, labels: np.ndarray, stands_for: np.ndarray) -> float:
    w = stands_for / (1.0 - np.minimum(cosines, 1.0) + SOFTEN)
    return float((w * labels).sum() / w.sum())


def isotonic(votes: np.ndarray, labels: np.ndarray, prior: float, stands_for: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (least vote, calibrated rate) of each level, rising.  An example counts ``stands_for`` rows."""
    stands_for = np.ones(len(votes)) if stands_for is None else stands_for
    order = np.argsort(votes, kind="stable")
    levels: list[list[float]] = []  # [least vote, sum, n]
    for v, y, w in zip(votes[order].tolist(), labels[order].tolist(), stands_for[order].tolist()):
        if levels and levels[-1][0] == v:
            levels[-1][1] += y * w
            levels[-1][2] += w
        else:
            levels.append([v, y * w, w])
        while len(levels) > 1 and levels[-2][1] * levels[-1][2] >= levels[-1][1] * levels[-2][2]:
            _, y2, n2 = levels.pop()
            levels[-1][1] += y2
            levels[-1][2] += n2
    rate = [(s + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT) for _, s, n in levels]
    return np.array([v for v, _, _ in levels]), np.maximum.accumulate(np.array(rate)) if rate else np.zeros(0)


class Model:
    """Vocabulary, index and calibration; plain arrays, so that it may be broadcast."""

    def __init__(self, idf: dict[str, float], examples: list[tuple], without: tuple[float, float], prior: float,
                 stands_for: tuple[float, float] = (1.0, 1.0)):
        """``examples``: (id, label, terms, weights); ``without``: (toxic, all) rows that the examples without a term
        stand for; ``stands_for``: rows that an example of label 0 and of label 1 stands for."""
        # neighbours of one strongest term share blocks, which keeps the block maxima tight
        examples = sorted(examples, key=lambda x: (int(x[2][int(np.argmax(x[3]))]), str(x[0])))
        self.idf, self.prior = idf, prior
        self.ids = [str(x[0]) for x in examples]
        self.labels = np.array([x[1] for x in examples], np.float64)
        self.stands_for = np.where(self.labels > 0, stands_for[1], stands_for[0])
        vectors = [(np.asarray(x[2], np.int64), np.asarray(x[3], np.float64)) for x in examples]
        self.index = BlockMaxIndex(len(idf), vectors)
        toxic, n = without
        self.rate_without = (toxic + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT)
        votes = [self._vote(*v, leave=i)[0] for i, v in enumerate(vectors)]
        seen = np.array([v is not None for v in votes], bool)
        self.from_vote, self.rate = isotonic(np.array([v for v in votes if v is not None], np.float64), self.labels[seen], prior,
                                             self.stands_for[seen])

    def _vote(self, terms: np.ndarray, weights: np.ndarray, leave: int = -1) -> tuple[float | None, np.ndarray, np.ndarray]:
        near, cos, _ = self.index.nearest(terms, weights, K, leave)
        return (vote(cos, self.labels[near], self.stands_for[near]) if len(near) else None), near, cos

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, str]:
        """(score, evidence "id:label:cosine,...")."""
        if not len(terms):
            return self.rate_without, ""
        v, near, cos = self._vote(terms, weights)
        if v is None or not len(self.rate):
            return self.prior, ""
        level = max(int(np.searchsorted(self.from_vote, v, "right")) - 1, 0)
        return float(self.rate[level]), ",".join(f"{self.ids[i]}:{int(self.labels[i])}:{c:.3f}" for i, c in zip(near, cos))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                  per_label: int) -> tuple[DataFrame, tuple[float, float]]:
    """(id, y, text) of about ``per_label`` labelled rows of each label that aren't held out, ids picked by hash; and how
    many labelled ids a picked one of label 0 and of label 1 stands for."""
    ids = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))) \
        .groupBy(F.col(key).alias("_id")).agg((F.max(label) > 0).cast("int").alias("_y"))
    n = {r["_y"]: r["count"] for r in ids.groupBy("_y").count().collect()}
    rate = F.when(F.col("_y") == 1, min(1.0, per_label / max(n.get(1, 0), 1))).otherwise(min(1.0, per_label / max(n.get(0, 0), 1)))
    u = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_id")), F.lit(1 << 30)) / float(1 << 30)
    chosen = written(ids.where(u < rate))  # bounded by the sample
    picked = {r["_y"]: r["count"] for r in chosen.groupBy("_y").count().collect()}
    stands_for = tuple(n.get(y, 0) / picked[y] if picked.get(y) else 1.0 for y in (0, 1))
    return docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id"), stands_for


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_label: int = TRAIN_ROWS) -> Model:
    small_batches(docs.sparkSession)
    rows, stands_for = training_rows(docs, labels, key, text, label, per_label)
    rows = written(rows)
    size = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    toxic, n = size.get(1, 0), sum(size.values())
    clean_rows, toxic_rows = (n - toxic) * stands_for[0], toxic * stands_for[1]
    prior = toxic_rows / (clean_rows + toxic_rows) if n else 0.0
    if toxic in (0, n):
        return Model({}, [], (toxic_rows, clean_rows + toxic_rows), prior)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(t, a, b) for t, (a, b) in seen.items()], columns=["term", "a", "b"])
            seen.clear()
            return out

        for batch in batches:
            for y, t in zip(batch["_y"].tolist(), batch["_text"].tolist()):
                for term in set(words(t)):
                    seen.setdefault(term, [0, 0])[1 - y] += 1
                if len(seen) > FLUSH_TERMS:
                    yield flush()
        yield flush()

    terms = rows.mapInPandas(count, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    found = terms.orderBy("term").toArrow()  # bounded by the sample's texts
    a, b = (found.column(c).to_numpy().astype(np.float64) for c in ("a", "b"))
    weight = (np.log((clean_rows + toxic_rows + 1) / (a * stands_for[1] + b * stands_for[0] + 1)) + 1) \
        * (FLOOR + telling(a, b, toxic, n - toxic))
    shared = rows.sparkSession.sparkContext.broadcast(dict(zip(found.column("term").to_pylist(), weight.tolist())))
    idf = shared.value

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Vectorizer(shared.value)
        for batch in batches:
            made = [own.vector(t) for t in batch["_text"].tolist()]
            yield pd.DataFrame({"_id": batch["_id"].astype(str), "_y": batch["_y"], "terms": [t.tolist() for t, _ in made],
                                "weights": [w.tolist() for _, w in made]})

    made = rows.mapInPandas(vectors, "_id string, _y int, terms array<long>, weights array<double>")
    full = made.where(F.size("terms") > 0).toArrow()  # bounded by the sample's texts
    ids, ys = full.column("_id").to_pylist(), full.column("_y").to_pylist()
    examples = [(i, y, t.values.to_numpy(), w.values.to_numpy())
                for i, y, t, w in zip(ids, ys, full.column("terms"), full.column("weights"))]
    toxic_without = (toxic - sum(ys)) * stands_for[1]
    clean_without = (n - toxic - len(ys) + sum(ys)) * stands_for[0]
    return Model(idf, examples, (toxic_without, toxic_without + clean_without), prior, stands_for)


_MODELS: dict[str, tuple[Model, Vectorizer]] = {}


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, evidence`` for every row; the model goes out once as a broadcast variable."""
    small_batches(docs.sparkSession)
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = (shared.value, Vectorizer(shared.value.idf))
        own, vectorizer = _MODELS[name]
        for batch in batches:
            out = pd.DataFrame([own.score(*vectorizer.vector(t)) for t in batch["_text"].tolist()], columns=["score", "evidence"])
            out.insert(0, key, batch["_key"].to_numpy())
            yield out

    src = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return src.mapInPandas(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double, evidence string")


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted, evidence``."""
    out = score(docs, fit(docs, labels, key, text, label), key, text)
    return out.select(key, held_out(F.col(key)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
