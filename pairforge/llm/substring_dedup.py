r"""Substring dedup: windows of words that start in an earlier document are found by a count-min prefilter and removed.

Words are the runs ``[^\x20\x09-\x0D]+`` of a text; a window is ``width`` consecutive words of one document.  A window
is covered by an earlier one if its word sequence also starts in a document of a smaller id; all words of such windows
are removed, judged on the input.  Windows are told apart by 96-bit hashes of their words (a trillion repeated windows
hold a pair of equal hashes with a chance of 1 in 100,000).

**Chunks.**  Texts are cut into words once.  A chunk holds the word numbers of some 4 MB of text, with the chunk's own
vocabulary, compressed; chunks are dealt out by their number and written to the shared folder that way, so the numbers are
stable, and the later passes bring the answers to the chunks without moving them again.

**First pass: sketches.**  A chunk's count-min sketch has ``DEPTH`` rows of cells, ``2**CELL_BITS`` per row and block;
the block is given by the top bits of a window's hash, and the number of blocks follows the number of windows, so the
load of a cell is the same at every size.  A chunk's counters are mostly 0 and none above 2 matters, so it sends, block
by block, the cells that it meets (twice where it meets them more often) as packed gaps, about two bytes a window and
row.  The owner of a block adds up the sketches of all chunks, and answers every chunk with one bit per cell sent: whether
the merged count is at least 2.

**Second pass: exact groups.**  A window whose estimate, the least of its cells' counts, is below 2 occurs once in all
texts and is done: an estimate never falls below the count, so nothing is lost.  The others, hash and the smallest
document of the chunk that holds them, once per chunk, meet in groups by hash, which give the exact smallest document; the
answer is one bit: whether another chunk holds it in an earlier document.  What a chunk's own documents say about each
other it knows itself.

A very common window counts once per chunk in either pass, so no group gathers its occurrences.  The answers return to
the chunks, and a chunk gives its documents' remaining words.

Rows: a null or empty text has no words and nothing to remove; a text of fewer than ``width`` words has no window and stays
whole.  Rows that repeat an id are judged one by one and don't remove from each other (the id isn't smaller).  A
null id takes no part: its row stays whole and removes nothing.  A window that a document repeats itself isn't removed for
that.  An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written, written_by
from .ngram_join import _grouped, mix64

WIDTH = 13
DEPTH = 2
#: Cells of a sketch row in one block, and the windows that a block is meant for: an eighth as many.
CELL_BITS = 23
BLOCK_WINDOWS = 1 << 20
CHUNK_BYTES = 4 << 20
#: Kinds of answers to a chunk.
_CELLS, _EARLIER = 1, 2


def narrow(values: np.ndarray, squeeze: bool = False) -> bytes:
    """Non-negative integers byte plane by byte plane, as many planes as the largest needs.  ``squeeze`` compresses the upper
    planes, where small numbers leave mostly zeros."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    low, high = planes[0].tobytes(), b"".join(p.tobytes() for p in planes[1:width])
    packed = zstandard.ZstdCompressor(level=1).compress(high) if squeeze and high else high
    short = len(packed) < len(high)
    return bytes([width, short]) + len(values).to_bytes(4, "little") + low + (packed if short else high)


def widen(data: bytes, start: int = 0, end: int | None = None) -> np.ndarray:
    """The integers of ``narrow``, as int64 bits."""
    width, short, n = data[start], data[start + 1], int.from_bytes(data[start + 2:start + 6], "little")
    low, high = data[start + 6:start + 6 + n], data[start + 6 + n:end]
    high = zstandard.ZstdDecompressor().decompress(high) if short else high
    planes = np.zeros((8, n), np.uint8)
    planes[:width] = np.frombuffer(low + high, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(n)


class _Numbers(dict):
    """Word -> its number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Chunk:
    """Documents of one chunk: ids (with ``known``), word numbers of all texts end to end, the vocabulary."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, words: np.ndarray, vocabulary: list[bytes]):
        self.ids, self.known, self.sizes, self.words, self.vocabulary = ids, known, sizes, words, vocabulary
        self.ends = np.cumsum(sizes)

    def packed(self) -> bytes:
        """Frequent words get small numbers, and numbers are laid out byte plane by byte plane, which compresses better."""
        counts = np.bincount(self.words, minlength=len(self.vocabulary))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        data = (self.ids, self.known, self.sizes, narrow(rank[self.words]), b" ".join([self.vocabulary[i] for i in order.tolist()]))
        return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(data, protocol=5))

    @classmethod
    def read(cls, blob: bytes) -> Chunk:
        ids, known, sizes, words, vocabulary = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
        return cls(ids, known, sizes, widen(words), vocabulary.split())

    def starts(self, width: int) -> np.ndarray:
        """Places of the windows, of documents whose id is known."""
        last = np.repeat(self.ends - width, self.sizes)  # the last start in each word's document
        return np.flatnonzero((np.arange(len(self.words)) <= last) & np.repeat(self.known, self.sizes))

    def documents(self, places: np.ndarray) -> np.ndarray:
        """Ids of the documents at these places."""
        return self.ids[np.searchsorted(self.ends, places, "right")]

    @cached_property
    def digests(self) -> np.ndarray:
        """Two 64-bit hashes of every word of the vocabulary."""
        return np.frombuffer(b"".join([blake2b(w, digest_size=16).digest() for w in self.vocabulary]), "<u8").reshape(-1, 2)

    def hashes(self, places: np.ndarray, width: int, half: int) -> np.ndarray:
        """One of two 64-bit hashes of the windows at ``places``."""
        if not len(places):
            return np.zeros(0, np.uint64)
        weights = mix64(np.arange(1, width + 1, dtype=np.uint64), 50 + half) | np.uint64(1)
        word, total = self.digests[:, half][self.words], np.full(len(places), width, np.uint64)
        for i in range(width):
            total += word[places + i] * weights[i]
        return mix64(total, half)


def chunks(df: DataFrame, key: str, text: str, width: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, windows, data): the texts as chunks of about ``chunk_bytes`` (one longer text is a chunk of its own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, words, seen, size = [], [], [], _Numbers(), 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            made = Chunk(np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], bool), np.array(sizes, np.int64),
                         np.concatenate(words) if words else np.zeros(0, np.uint32), list(seen))
            number += 1
            out = pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), pa.array([len(made.starts(width))], pa.int64()),
                                              pa.array([made.packed()], pa.binary())], names=["chunk", "windows", "data"])
            for held in (ids, sizes, words, seen):
                held.clear()
            return out

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass")
                if ids and size + len(raw) > chunk_bytes:
                    yield flush()
                    size = 0
                own = raw.split()
                ids.append(i)
                sizes.append(len(own))
                words.append(np.fromiter(map(seen.__getitem__, own), np.uint32, len(own)))
                size += len(raw) + 64
        if ids:
            yield flush()

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "chunk long, windows long, data binary")


class Blocks:
    """How hashes fall into blocks of the sketch."""

    def __init__(self, windows: int, cell_bits: int = CELL_BITS, block_windows: int = BLOCK_WINDOWS):
        self.bits, self.cell_bits = int(windows // block_windows).bit_length(), cell_bits

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        """Numbers of the hashes' cells in one row of the sketch: block, then cell."""
        cell = mix64(hashes, 20 + row) & np.uint64((1 << self.cell_bits) - 1)
        return (self.of(hashes) << self.cell_bits) | cell.astype(np.int64)

    def split(self, cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(block, cells within it) of sorted cell numbers."""
        low = cells & ((1 << self.cell_bits) - 1)
        for block, s, e in _grouped(cells >> self.cell_bits):
            yield block, low[s:e]


def sketch(cells: np.ndarray) -> np.ndarray:
    """Sorted cell numbers, each as often as it is met, but at most twice."""
    cells = np.sort(cells)
    return cells[np.concatenate((np.ones(min(2, len(cells)), bool), cells[2:] != cells[:-2]))]


def merged(sketches: list[np.ndarray]) -> list[np.ndarray]:
    """For each of the sketches of one block, whether the merged count of its cells is at least 2."""
    cells, counts = np.unique(np.concatenate(sketches), return_counts=True)
    often = cells[counts > 1]
    return [_among(s, often) for s in sketches]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted known ones; most that aren't fall out by their low bits."""
    if not len(known):
        return np.zeros(len(values), bool)
    mask = (1 << max(16, min(22, len(known).bit_length() + 4))) - 1
    table = np.zeros(mask + 1, bool)
    table[known & mask] = True
    out = table[values & mask]
    at = np.flatnonzero(out)
    out[at] = known[np.minimum(np.searchsorted(known, values[at]), len(known) - 1)] == values[at]
    return out


def _bits(messages: list[tuple[int, bytes]], sizes: dict[int, int]) -> np.ndarray:
    """Answers of all blocks, in block order, as one boolean per item sent; ``sizes``: items sent to each block."""
    answer = dict(messages)
    parts = [np.unpackbits(np.frombuffer(answer[b], np.uint8), count=n).astype(bool) for b, n in sorted(sizes.items())]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


class Candidates:
    """Windows of a chunk that the merged sketches take for repeated."""

    def __init__(self, chunk: Chunk, answers: list[tuple[int, int, bytes]], blocks: Blocks, width: int):
        """``answers``: (row, block, bits)."""
        places = chunk.starts(width)
        first = chunk.hashes(places, width, 0)
        repeated = np.ones(len(places), bool)
        for row in range(DEPTH):
            cells = blocks.cells(first, row)
            sent = sketch(cells)
            sizes = {b: len(low) for b, low in blocks.split(sent)}
            often = sent[_bits([(b, bits) for r, b, bits in answers if r == row], sizes)]
            repeated &= _among(cells, often)
        self.places = places[repeated]
        first, second = first[repeated], chunk.hashes(self.places, width, 1) >> np.uint64(32)
        documents = chunk.documents(self.places)
        order = np.lexsort((documents, second, first))
        same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
        new = np.concatenate((np.ones(min(1, len(order)), bool), ~same))
        heads = order[new]
        #: One entry per distinct window, in hash order: hash halves and the smallest document.
        self.first, self.second, self.least = first[heads], second[heads], documents[heads]
        self.block = blocks.of(self.first)
        self.entry = np.empty(len(order), np.int64)  # entry of every place
        self.entry[order] = np.cumsum(new) - 1
        self.documents = documents

    def sent(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(block, hashes, documents) messages of the entries."""
        for block, s, e in _grouped(self.block):
            gaps, base = np.diff(self.first[s:e], prepend=np.uint64(0)), int(self.least[s:e].min())
            first = narrow(gaps)
            yield block, len(first).to_bytes(4, "little") + first + narrow(self.second[s:e]), \
                base.to_bytes(8, "little", signed=True) + narrow(self.least[s:e] - base)

    def removed(self, answers: list[tuple[int, bytes]], size: int, width: int) -> np.ndarray:
        """Which of the chunk's ``size`` words go; ``answers``: (block, bits)."""
        earlier = _bits(answers, {b: e - s for b, s, e in _grouped(self.block)})
        gone = self.places[earlier[self.entry] | (self.documents > self.least[self.entry])]
        edges = np.zeros(size + 1, np.int64)
        np.add.at(edges, gone, 1)
        np.add.at(edges, gone + width, -1)
        return np.cumsum(edges[:-1]) > 0


def _hashes(data: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    return np.stack([np.cumsum(widen(data, 4, cut).view(np.uint64)), widen(data, cut).view(np.uint64)])


def _documents(data: bytes) -> np.ndarray:
    return widen(data, 8) + int.from_bytes(data[:8], "little", signed=True)


def earlier_elsewhere(entries: list[tuple[bytes, bytes]]) -> list[np.ndarray]:
    """For the (hashes, documents) messages of one block, whether each window has an earlier document in another one."""
    halves = [_hashes(h) for h, _ in entries]
    documents = [_documents(d) for _, d in entries]
    hashes, least = np.concatenate(halves, axis=1), np.concatenate(documents)
    order = np.lexsort((least, hashes[1], hashes[0]))
    sorted_ = hashes[:, order]
    new = np.concatenate(([True], (sorted_[:, 1:] != sorted_[:, :-1]).any(axis=0)))[:len(order)]
    group = np.cumsum(new) - 1
    later = np.empty(len(order), bool)
    later[order] = least[order] > least[order][new][group]
    return np.split(later, np.cumsum([len(d) for d in documents])[:-1])


def dedup_substrings(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``key, n_words, n_removed, kept`` for every row: ``kept`` is the remaining words, joined by one space."""
    small_batches(df.sparkSession)
    cut = written_by(chunks(df, key, text, width), "chunk", df.rdd.getNumPartitions())
    blocks = Blocks(cut.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0])
    message = "block long, chunk long, kind int, part int, data binary, more binary"
    bodies = cut.select("chunk", "data").groupBy("chunk")

    def send_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist()):
                chunk = Chunk.read(blob)
                first = chunk.hashes(chunk.starts(width), width, 0)
                rows = [(b, number, _CELLS, r, narrow(np.diff(low, prepend=0), True), b"") for r in range(DEPTH) for b, low in blocks.split(sketch(blocks.cells(first, r)))]
                yield _messages(rows)

    def merge_cells(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        often = merged([np.cumsum(widen(d)) for d in pdf["data"]])
        return pd.DataFrame({"block": pdf["block"], "chunk": pdf["chunk"], "kind": _CELLS, "part": pdf["part"],
                             "data": [np.packbits(o).tobytes() for o in often], "more": b""})

    answers = written(cut.select("chunk", "data").mapInArrow(send_cells, message).groupBy("part", "block").applyInPandas(merge_cells, message))

    def read(body: pd.DataFrame, answers: pd.DataFrame) -> tuple[Chunk, Candidates]:
        chunk, own = Chunk.read(body["data"].iloc[0]), answers[answers["kind"] == _CELLS]
        return chunk, Candidates(chunk, list(zip(own["part"], own["block"], own["data"])), blocks, width)

    def send_windows(key: tuple, body: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = [(b, key[0], _EARLIER, 0, h, d) for b, h, d in read(body, answers)[1].sent()]
        return pd.DataFrame(rows, columns=["block", "chunk", "kind", "part", "data", "more"])

    def group_windows(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        earlier = earlier_elsewhere(list(zip(pdf["data"], pdf["more"])))
        return pd.DataFrame({"block": pdf["block"], "chunk": pdf["chunk"], "kind": _EARLIER, "part": 0,
                             "data": [np.packbits(x).tobytes() for x in earlier], "more": b""})

    second = written(bodies.cogroup(answers.groupBy("chunk")).applyInPandas(send_windows, message)
                     .groupBy("block").applyInPandas(group_windows, message))

    def remaining(key: tuple, body: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        chunk, found = read(body, answers)
        own = answers[answers["kind"] == _EARLIER]
        gone = found.removed(list(zip(own["block"], own["data"])), len(chunk.words), width)
        kept, removed = [], np.zeros(len(chunk.ids), np.int64)
        for d, (s, e) in enumerate(zip(chunk.ends - chunk.sizes, chunk.ends)):
            stay = ~gone[s:e]
            removed[d] = e - s - stay.sum()
            kept.append(b" ".join(map(chunk.vocabulary.__getitem__, chunk.words[s:e][stay].tolist())).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"id": pd.Series(chunk.ids, dtype="Int64").where(chunk.known), "n_words": chunk.sizes, "n_removed": removed, "kept": kept})

    out = bodies.cogroup(answers.unionByName(second).groupBy("chunk")).applyInPandas(remaining, "id long, n_words long, n_removed long, kept string")
    return out.select(F.col("id").cast(df.schema[key].dataType).alias(key), "n_words", "n_removed", "kept")


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["block", "chunk", "kind", "part", "data", "more"])
