"""Byte-level BPE encoding and decoding with a pair occurrence index.

The vocabulary is read from a public tokenizer file whose path is a parameter.
A text is cut at the special tokens and then into pieces by the file's fixed
pattern; all new pieces of a chunk of texts are merged together:

* every piece's bytes lie in one symbol array, linked to their neighbours;
* the index maps each mergeable pair, by rank, to all its positions;
* a heap holds the active ranks; the lowest is applied at all its positions at
  once (leftmost first where the pair overlaps itself), and the lists of the
  new pairs to the left and the right grow by these positions.

Applying a rank everywhere at once equals merging piece by piece because a
merge's parts are always made by lower ranks; ``Vocabulary`` refuses a file
where that does not hold.  Encoded pieces are kept per Python worker and query in a cache
of at most ``CACHE_PIECES`` pieces; chunks hold about ``CHUNK_CHARS`` characters, so
memory does not grow with a partition.

Rows: a null text is an empty text (0 tokens).  Results are per row, so
repeated rows give repeated results and an empty table an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import BATCH_ROWS, small_batches

#: A piece takes about 650 bytes in the cache, and merging a chunk's new pieces several times its text.
CHUNK_CHARS = 2_000_000
CACHE_PIECES = 100_000
# The pattern that cuts text before the merges.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def byte_alphabet() -> dict[int, str]:
    """How the file writes each byte: printable Latin-1 as itself, the others from U+0100 on in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE file."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["type"] != "BPE":
            raise ValueError("not a plain byte-level BPE file")
        ids, byte = model["vocab"], {c: b for b, c in byte_alphabet().items()}
        self.byte_id = np.zeros(256, np.int32)
        for c, b in byte.items():
            self.byte_id[b] = ids[c]
        self.size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int32)
        born = np.full(self.size, -1, np.int64)
        born[self.made] = np.arange(len(pairs))
        if len(np.unique(self.made)) != len(pairs) or (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a token that a later rank makes; ranks can't be applied in ascending order")
        key = left * self.size + right
        order = np.argsort(key)
        self.keys, self.rank_of = key[order], order.astype(np.int32)
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of every pair (a, b), or -1."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)


def _leftmost(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of sorted positions of a pair (x, x), those that a scan from the left merges."""
    chained = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
    start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def merge_pieces(vocab: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces (none is empty), one after another, and the bounds of each piece's share."""
    if not pieces:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    sym = vocab.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
    n = len(sym)
    ends = np.cumsum(lengths)
    first = np.zeros(n + 1, bool)  # position n stands for "none"
    first[ends - lengths] = first[n] = True
    nxt = np.arange(1, n + 1)
    nxt[first[1:]] = n
    prv = np.arange(-1, n - 1)
    prv[first[:n]] = n
    sym, nxt, prv = np.append(sym, -1), np.append(nxt, n), np.append(prv, n)

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enlist(at: np.ndarray) -> None:
        """Put pairs that start at ``at`` on the lists of their ranks."""
        ranks = vocab.ranks(sym[at], sym[nxt[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(at, cuts)):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(part)

    enlist(np.flatnonzero(nxt[:n] < n))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        a, b = vocab.left[rank], vocab.right[rank]
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        at = at[(sym[at] == a) & (sym[nxt[at]] == b)]  # positions that an earlier merge has taken drop out
        if not len(at):
            continue
        if len(lists) > 1:
            at = np.unique(at)
        if a == b:
            at = _leftmost(at, nxt)
        gone = nxt[at]
        after = nxt[gone]
        sym[at], sym[gone] = vocab.made[rank], -1
        nxt[at] = after
        prv[after] = at
        before = prv[at]
        prv[n], sym[n] = n, -1
        enlist(np.unique(np.concatenate((before[before < n], at[after < n]))))
    alive = sym[:n] >= 0
    return sym[:n][alive], np.append(0, np.cumsum(np.add.reduceat(alive, ends - lengths, dtype=np.int64)))


class _Cache(dict):
    """Piece -> number; new pieces queue up in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Coder:
    """Encodes and decodes chunks of texts; keeps what it has learned about pieces.

    It goes out as a broadcast variable, so a worker that lives on drops it, and the pieces, with its next task of another stage."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.decimal = list(map(str, range(vocab.size)))
        self._reset()

    def _reset(self) -> None:
        self.number = _Cache()
        self.ids: list[str] = []  # of each piece: decimal ids joined by commas
        self.bytes: list[bytes] = []  # of each piece: what its ids decode to
        self.count = np.zeros(0, np.int64)
        for text in self.vocab.special:  # specials come first
            self.number[text]
            self._learn([self.vocab.special[text]], [0, 1])
        self.number.new = []

    def _learn(self, tokens: list[int], bounds: list[int]) -> None:
        for s, e in zip(bounds, bounds[1:]):
            own = tokens[s:e]
            self.ids.append(",".join([self.decimal[t] for t in own]))
            self.bytes.append(self.decode(own))
        self.count = np.append(self.count, np.diff(bounds))

    def rows(self, texts: list[str | None]) -> list[list[int]]:
        """Every text as numbers of pieces, all of them learned."""
        if len(self.number) > CACHE_PIECES:
            self._reset()
        number, find, special = self.number, PIECES.findall, self.vocab.special
        rows = []
        for text in texts:
            text = text or ""
            if any(s in text for s in special):
                row, at = [], 0
                for m in self.vocab.cut.finditer(text):
                    row += [number[p] for p in find(text[at:m.start()])]
                    row.append(number[m.group()])
                    at = m.end()
                row += [number[p] for p in find(text[at:])]
            else:
                row = [number[p] for p in find(text)]
            rows.append(row)
        new, number.new = number.new, []
        tokens, bounds = merge_pieces(self.vocab, [p.encode() for p in new])
        self._learn(tokens.tolist(), bounds.tolist())
        return rows

    def n_tokens(self, row: list[int]) -> int:
        return int(self.count[row].sum()) if row else 0

    def joined_ids(self, row: list[int]) -> str:
        """Decimal ids joined by commas."""
        ids = self.ids
        return ",".join([ids[i] for i in row])

    def text(self, row: list[int]) -> str:
        """What the row's ids decode to: the pieces' decoded bytes end to end, broken UTF-8 replaced."""
        own = self.bytes
        return b"".join([own[i] for i in row]).decode("utf-8", "replace")

    def encode(self, text: str | None) -> list[int]:
        ids = self.joined_ids(self.rows([text])[0])
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of token ids, special tokens kept."""
        own = self.vocab.bytes
        return b"".join([own[i] for i in ids])


def _int_lists(joined: list[str]) -> pa.ListArray:
    """Decimal ids joined by commas -> lists of ints, without a Python object for each id."""
    rows = [np.fromstring(x, np.int32, sep=",") if x else np.zeros(0, np.int32) for x in joined]
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, rows)], dtype=np.int32), np.concatenate([np.zeros(0, np.int32), *rows]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``CHUNK_CHARS`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_CHARS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def bpe_round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, an int array) of every row: the text is encoded,
    the ids are decoded, and both are hashed."""
    small_batches(df.sparkSession)
    id_type = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(Coder(Vocabulary.load(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for chunk in _chunks(batches):
            rows = code.rows(chunk.column(1).to_pylist())
            for at in range(0, len(rows), BATCH_ROWS):  # ids and decoded texts of a few rows at once
                some = rows[at:at + BATCH_ROWS]
                ids = [code.joined_ids(row) for row in some]
                out = [chunk.column(0).slice(at, len(some)), pa.array(map(code.n_tokens, some), pa.int64()), pa.array(map(sha, ids), pa.string()),
                       pa.array([sha(code.text(row)) for row in some], pa.string())]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out.append(_int_lists(ids))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
            pa.default_memory_pool().release_unused()

    schema = f"`{key}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return df.select(df[key].alias("_key"), df[text].alias("_text")).mapInArrow(run, schema)
