r"""Spelling variant grouping by Bloom-guided neighbourhoods.

``words`` counts words over all texts: maximal runs of a character class, A-Z lower-cased, at least ``least_length`` code
points and ``least_count`` occurrences.  Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  A word's form is its near word of the largest count (ties: smallest in code-point order), if that is at
least ``ratio`` times the word's own; its root is where the forms lead.

**Neighbourhoods.**  A word generates its edits: each code point deleted, and each replaced by each other code point of
the vocabulary.  (An insertion is a deletion seen from the longer word.)  A word's hash is the sum of one hash per
(place, code point), so the hashes of all its edits follow from prefix sums, without building a string.  Every edit is
probed against a blocked Bloom filter of the vocabulary's words of its length; a block is 512 bits, so a probe touches one
cache line.  Only edits that the filter takes for words are spelled out and shuffled to an exact join with the vocabulary,
which removes the false positives; a Bloom filter has no false negatives, so no near word is lost.

**Filters.**  They are sharded by word length, and a shard by hash into slices of about ``SLICE_WORDS`` words; each slice is
built from its own words in one small group.  Filters are broadcast in rounds of at most ``ROUND_BYTES``; in a round a
word probes only the edits that fall into the round's slices.  A vocabulary within one round (some 20 million words) needs one
pass over it, a larger one as many as it has rounds; no broadcast grows with the data.

**Counting** is a grouping with partial sums, so a very common word costs a row per task.  Roots are found by doubling: a
word's target gives way to its target's target until nothing changes; counts grow ``ratio``-fold along a chain, so
these are few rounds.

Rows: a null or empty text has no runs.  A null id counts as empty text in a run's hash.  Rows that repeat count as
often as they occur.  A very long run is a word like any other: it generates replacements only if another word has its
length, and deletions only if one is a code point shorter.  A table without words gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .ngram_join import mix64

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: Bloom filters: bits per word, bits set per word, bits of a block.
WORD_BITS = 16
PROBES = 8
BLOCK_BITS = 512
SLICE_WORDS = 1 << 17
ROUND_BYTES = 40 << 20
#: Lengths from this one on share a shard.
LONGEST = 64
#: Hashes of edits that a task holds at once.
EDITS = 1 << 18


def runs(docs: DataFrame, key: str, text: str, run: str = RUN) -> DataFrame:
    """(id, run) of all runs, lower-cased."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(run), F.lit(0)))
    return docs.select(F.col(key).alias("id"), found.alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))


def with_slips(found: DataFrame, every: int = 31) -> Column:
    """The run, or where ``every`` divides crc32("<id>:<run>") the run without its code point crc32 mod length."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.char_length("run").cast("long")).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return F.when(F.pmod(h, F.lit(every)) == 0, without).otherwise(F.col("run"))


def words(found: DataFrame, word: Column, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    long = found.where(F.char_length("run") >= least_length).select(word.alias("word")).where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# --- hashes of words and edits

def place_hashes(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hash of a code point at a place; a word's hash is their sum."""
    return mix64((places.astype(np.uint64) << np.uint64(21)) | codes.astype(np.uint64), 40)


def finish(sums: np.ndarray, length: int) -> np.ndarray:
    return mix64(sums + np.uint64(length), 41)


def code_points(batch: list[str], length: int) -> np.ndarray:
    """(words, length) code points of words of one length."""
    return np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    length = codes.shape[1]
    return finish(place_hashes(np.arange(length)[None, :], codes).sum(axis=1, dtype=np.uint64), length)


def replacement_hashes(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """(words, places, alphabet) hashes of the words with one code point replaced."""
    length = codes.shape[1]
    own = place_hashes(np.arange(length)[None, :], codes)
    other = place_hashes(np.arange(length)[:, None], alphabet[None, :])
    return finish((own.sum(axis=1, dtype=np.uint64)[:, None] - own)[:, :, None] + other[None, :, :], length)


def deletion_hashes(codes: np.ndarray) -> np.ndarray:
    """(words, places) hashes of the words without one code point."""
    length = codes.shape[1]
    stay = np.cumsum(place_hashes(np.arange(length)[None, :], codes), axis=1, dtype=np.uint64)
    move = np.cumsum(place_hashes(np.arange(length)[None, :] - 1, codes)[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    none = np.zeros((len(codes), 1), np.uint64)
    return finish(np.concatenate((none, stay[:, :-1]), axis=1) + np.concatenate((move[:, 1:], none), axis=1), length - 1)


# --- blocked Bloom filters

def _bit_places(hashes: np.ndarray, blocks: int) -> Iterator[np.ndarray]:
    """The ``PROBES`` bits of every hash, one after the other; all lie in one block."""
    base = ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)) * np.uint64(BLOCK_BITS)
    more = mix64(hashes, 42)
    for i in range(PROBES):
        if i == 7:
            more = mix64(hashes, 43)
        yield base + ((more >> np.uint64(9 * (i % 7))) & np.uint64(BLOCK_BITS - 1))


def build_filter(hashes: np.ndarray) -> np.ndarray:
    """Blocked Bloom filter of a slice's words, as bytes."""
    blocks = max(1, -(-len(hashes) * WORD_BITS // BLOCK_BITS))
    bits = np.zeros(blocks * BLOCK_BITS, np.uint8)
    for at in _bit_places(hashes, blocks):
        bits[at.astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


class Filters:
    """Filters of one round, by (shard, slice), laid end to end."""

    def __init__(self, slices: dict[int, int], filters: dict[tuple[int, int], bytes]):
        """``slices``: number of slices per shard; only the slices in ``filters`` belong to the round."""
        self.slices, self.bits = slices, np.frombuffer(b"".join(filters.values()), np.uint8)
        self.start: dict[int, np.ndarray] = {}
        self.blocks: dict[int, np.ndarray] = {}
        at = 0
        for (shard, part), data in filters.items():
            if shard not in self.start:
                self.start[shard], self.blocks[shard] = (np.zeros(slices[shard], np.int64) for _ in range(2))
            self.start[shard][part], self.blocks[shard][part] = at * 8, len(data) * 8 // BLOCK_BITS
            at += len(data)

    def hits(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        """Flat positions of the hashes that the round's filters hold."""
        if shard not in self.start:
            return np.zeros(0, np.int64)
        flat = hashes.ravel()
        part = slice_of(flat, self.slices[shard])
        blocks = self.blocks[shard][part]
        at = np.flatnonzero(blocks > 0)
        flat, blocks, start = flat[at], blocks[at].astype(np.uint64), self.start[shard][part[at]]
        base = ((flat >> np.uint64(32)) * blocks >> np.uint64(32)).astype(np.int64) * BLOCK_BITS + start
        more = mix64(flat, 42)
        for i in range(PROBES):
            if i == 7:
                more = mix64(flat, 43)
            bit = base + ((more >> np.uint64(9 * (i % 7))) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
            held = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            at, base, more, flat = at[held], base[held], more[held], flat[held]
        return at


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def shard_of(length: int) -> int:
    return min(length, LONGEST)


def _by_length(batch: list[str]) -> Iterator[tuple[int, list[str]]]:
    lengths: dict[int, list[str]] = {}
    for w in batch:
        lengths.setdefault(len(w), []).append(w)
    yield from sorted(lengths.items())


def filters_of(vocabulary: DataFrame, slices: dict[int, int]) -> DataFrame:
    """(shard, part, bits) of every slice of the vocabulary."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, own in _by_length(batch.column(0).to_pylist()):
                shard, h = shard_of(length), word_hashes(code_points(own, length))
                part = slice_of(h, slices[shard])
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                groups = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(groups), pa.int32()), pa.array([int(part[g[0]]) for g in groups], pa.int32()),
                     pa.array([h[g].tobytes() for g in groups], pa.binary())], names=["shard", "part", "data"])

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(d, np.uint64) for d in pdf["data"]])
        return pd.DataFrame({"shard": [key[0]], "part": [key[1]], "bits": [build_filter(h).tobytes()]})

    return vocabulary.select("word").mapInArrow(hashed, "shard int, part int, data binary") \
        .groupBy("shard", "part").applyInPandas(build, "shard int, part int, bits binary")


def edits(batch: list[str], alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[str, str, bool]]:
    """(word, edit, whether by deletion) of the edits that the round's filters take for words."""
    for length, own in _by_length(batch):
        codes = code_points(own, length)
        if shard_of(length) in filters.start:
            # a very long word's replacements are taken place by place, so that a task never holds them all
            step = max(1, EDITS // max(1, length * len(alphabet)))
            for s in range(0, len(own), step):
                part = codes[s:s + step]
                if length * len(alphabet) <= EDITS:
                    places = [(0, replacement_hashes(part, alphabet))]
                else:
                    sums = place_hashes(np.arange(length)[None, :], part)
                    total = sums.sum(axis=1, dtype=np.uint64)
                    wide = max(1, EDITS // len(alphabet))
                    places = ((p, finish((total[:, None] - sums[:, p:p + wide])[:, :, None] + place_hashes(
                        np.arange(p, min(p + wide, length))[:, None], alphabet[None, :])[None, :, :], length)) for p in range(0, length, wide))
                for first, hashes in places:
                    _, n, letters = hashes.shape
                    for at in filters.hits(shard_of(length), hashes).tolist():
                        w, rest = divmod(at, n * letters)
                        place, letter = first + rest // letters, int(alphabet[rest % letters])
                        if letter != part[w, place]:
                            word = own[s + w]
                            yield word, word[:place] + chr(letter) + word[place + 1:], False
        if length > 1 and shard_of(length - 1) in filters.start:
            step = max(1, EDITS // length)
            for s in range(0, len(own), step):
                for at in filters.hits(shard_of(length - 1), deletion_hashes(codes[s:s + step])).tolist():
                    w, place = divmod(at, length)
                    word = own[s + w]
                    if place == 0 or word[place] != word[place - 1]:  # of equal neighbours one deletion is enough
                        yield word, word[:place] + word[place + 1:], True


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every word of the written (word, n) with each of its near words."""
    spark = vocabulary.sparkSession
    lengths = vocabulary.groupBy(F.least(F.char_length("word"), F.lit(LONGEST)).alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()
    slices = {r["shard"]: max(1, -(-r["n"] // SLICE_WORDS)) for r in lengths}
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().where("letter <> ''").collect()
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters), np.uint32)
    built = written(filters_of(vocabulary, slices))
    rounds, size = [[]], 0
    for r in built.select("shard", "part", F.length("bits").alias("size")).orderBy("shard", "part").toLocalIterator():
        if rounds[-1] and size + r["size"] > ROUND_BYTES:
            rounds.append([])
            size = 0
        rounds[-1].append((r["shard"], r["part"]))
        size += r["size"]
    found = None
    for own in rounds:
        first, last = (own or [(0, 0)])[0], (own or [(0, 0)])[-1]
        place = F.struct("shard", "part")
        mine = built.where((place >= F.struct(F.lit(first[0]), F.lit(first[1]))) & (place <= F.struct(F.lit(last[0]), F.lit(last[1]))))
        filters = spark.sparkContext.broadcast(Filters(slices, {(r["shard"], r["part"]): bytes(r["bits"]) for r in mine.collect()}))

        def probe(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                rows = list(edits(list(n), alphabet, filters.value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _, _ in rows], pa.string()), pa.array([n[w] for w, _, _ in rows], pa.int64()),
                     pa.array([e for _, e, _ in rows], pa.string()), pa.array([d for _, _, d in rows], pa.bool_())], names=["word", "n", "near", "shorter"])

        taken = vocabulary.select("word", "n").mapInArrow(probe, "word string, n long, near string, shorter boolean")
        taken = written(taken) if len(rounds) > 1 else taken
        found = taken if found is None else found.unionByName(taken)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found.join(known, "near")
    # a word generates its shorter neighbours only: they get the longer one from the same row
    both = F.when(F.col("shorter"), F.array(F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))) \
        .otherwise(F.array(F.struct("word", "n", "near", "near_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the written (word, form): where the forms lead."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = written(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def group_variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of (word, n); words are distinct."""
    vocabulary = written(vocabulary.select("word", F.col("n").cast("long").alias("n")))
    best = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best"))
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    judged = written(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.minus")).alias("form_n")))
    led = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
