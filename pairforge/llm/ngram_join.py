r"""N-gram Jaccard join by multiple-global-order prefix filtering, and the components of its links.

A document's set holds the distinct ``n``-word shingles of its words ``[^\x20\x09-\x0D]+``, A-Z lower-cased (a shorter
text is one shingle; one without words has an empty set and links with nothing).  Two documents link when
``100 * intersection >= percent * union``.  Shingles are told apart by 64-bit hashes.  Documents of equal sets form a class; only classes are compared.

Under any total order of shingles, two sets that link share a shingle among the first
``m - ceil(percent/100 * m) + 1`` of each set of size m (prefix filter).  Every order here puts the common shingles last, by their
counts over all documents (the ``HEAVY`` most frequent ones; which shingles these are changes the work, never the
result), and breaks ties by a hash of its own.  The first order's prefixes are joined on equal shingles; a pair is a
candidate only if it also passes, in the same task, the set-size bound and the bound from parity bitmaps
(``|A xor B|`` is at least the bitmaps' distance).  Then the prefixes of every further order (``ORDERS``), as 32-bit hashes,
are brought together, and only pairs that share a shingle under each of them see their sets.

Sets travel as the top bits of their hashes, packed (``packed_set``, about two bytes a shingle).  Their intersection is off
by the truncated hashes that fall together.  Those within a set are known exactly, so a pair is refused only
where it surely doesn't link; those across sets are rare and counted against the pair with a margin that they exceed with a
chance below 1e-12.  A pair that is decided neither way is verified on whole 64-bit hashes, as are small sets from the start.

Groups of near copies link almost all to all, so candidates are taken in two rounds.  In the first, each posting list
compares its members with ``PIVOTS`` of them; verified links give components.  In the second, every pair of a list whose
members lie in different components is compared.  Lists of up to ``WIDE_LIST`` members send their candidates on to be
verified; to longer ones the members' sets come, and only links that join components leave the task (``joining_links``).
A pair that is skipped is in one component already, so components are those of all links.  A list of more than ``LIST_ROWS``
members is cut in parts, in the second round compared part by part (every pair of parts is one group), so that no task
holds a whole hot list.

Rows: a null text has an empty set; its component is its own id.  Rows that repeat an id are judged by each one's
text, and the id's component is that of all its rows.  An empty table gives an empty result.  Ids are integers; a
null id takes no part in links and gets a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, keep_ids, small_batches, written

N = 4
PERCENT = 85
ORDERS = 3
HEAVY = 1 << 22  # 48 MB as a broadcast
PIVOTS = 8
PIVOT_CLASSES = 8
BITMAP = 11
LIST_ROWS = 2_048
#: Open lists of more members are compared with their members' sets at hand; see ``joining_links``.
WIDE_LIST = 64
#: Shingles of the sets in a part of such lists, about.
PART_SHINGLES = 1 << 19
#: Sets of up to this many shingles travel as 64-bit hashes, larger ones as 24 bits, or from the second size on as 32.
SMALL_SET, LARGE_SET = 256, 4_096
MARGIN = 4
#: Shingles per group of the counting step, about.
GROUP_SHINGLES = 1 << 19
#: Marks per heavy shingle, at least, of the table that tells most light ones.
MARKS = 16
FLUSH_PAIRS = 200_000
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that looks random; one per seed."""
    x = x + np.uint64(_MIX[0] * (2 * seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, n: int = N):
        self.n = n
        # a shingle hashes to a weighted sum of its words' hashes, mixed; the weights tell the places apart
        self.weights = [np.uint64(x) for x in mix64(np.arange(1, n + 1, dtype=np.uint64), 99) | np.uint64(1)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        span = min(self.n, len(words))
        out = np.full(len(h) - span + 1, span, np.uint64)
        for i in range(span):
            out += h[i:len(h) - span + 1 + i] * self.weights[i]
        out = mix64(out)
        out.sort()
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


class Orders:
    """Global orders: heavy shingles last, rising by count; ties by a hash per order.

    Heavy shingles are known by all but their lowest ``shift`` bits; see ``survey``."""

    def __init__(self, heavy: np.ndarray, counts: np.ndarray, shift: int):
        order = np.argsort(heavy)
        self.heavy, self.counts, self.shift = heavy[order], np.minimum(counts[order], (1 << 31) - 1).astype(np.int32), np.uint64(shift)
        self.marks: np.ndarray | None = None

    def _marked(self, shingles: np.ndarray) -> np.ndarray:
        """Places of the shingles whose top bits some heavy one has; the table of these bits is made once per worker."""
        bits = min((MARKS * len(self.heavy)).bit_length(), 64 - int(self.shift))
        if self.marks is None:
            top = self.heavy >> np.uint64(64 - int(self.shift) - bits)
            self.marks = np.zeros(max(1, 1 << bits >> 3), np.uint8)
            np.bitwise_or.at(self.marks, (top >> np.uint64(3)).astype(np.int64), np.uint8(1) << (top & np.uint64(7)).astype(np.uint8))
        top = shingles >> np.uint64(64 - bits)
        return np.flatnonzero(self.marks[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8) & 1)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """Count of heavy shingles, 0 for the others."""
        out = np.zeros(len(shingles), np.int32)
        if len(self.heavy):
            marked = self._marked(shingles)
            keys = shingles[marked] >> self.shift
            at = np.minimum(np.searchsorted(self.heavy, keys), len(self.heavy) - 1)
            out[marked] = np.where(self.heavy[at] == keys, self.counts[at], 0)
        return out

    def prefixes(self, shingles: np.ndarray, orders: range, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray]]:
        """(shingles, weights) of the prefix under each order."""
        weight, length = self.weights(shingles), prefix_length(len(shingles), percent)
        light, out = np.flatnonzero(weight == 0), []
        for order in orders:
            if length < len(light):  # no heavy one gets in: the smallest hashes among the light ones
                first = light[np.argpartition(mix64(shingles[light], 100 + order), length)[:length]]
            else:
                first = np.lexsort((mix64(shingles, 100 + order), weight))[:length]
            out.append((shingles[first], weight[first]))
        return out


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity bitmap: bit i is the parity of the shingles that hash to i; about as many bits as shingles, at most
    ``1 << BITMAP``: a long text has many postings, and each carries the bitmap."""
    bits = 1 << min(max(int(len(shingles)).bit_length(), 8), BITMAP)
    parity = np.bincount((mix64(shingles, 7) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def distance(a: int, bytes_a: int, b: int, bytes_b: int) -> int:
    """Differing bits of two bitmaps, as integers; the longer one is folded by xor to the shorter one's length.  At
    most the size of the sets' symmetric difference, for each of its shingles flips one bit."""
    while bytes_a > bytes_b:
        bytes_a >>= 1
        a = (a >> 8 * bytes_a) ^ (a & ((1 << 8 * bytes_a) - 1))
    while bytes_b > bytes_a:
        bytes_b >>= 1
        b = (b >> 8 * bytes_b) ^ (b & ((1 << 8 * bytes_b) - 1))
    return (a ^ b).bit_count()


def may_link(n_a: int, n_b: int, differ: int, percent: int = PERCENT) -> bool:
    """Whether sets of these sizes whose symmetric difference is at least ``differ`` can link.

    With the sum S of the sizes and the difference D, intersection and union are (S - D) / 2 and (S + D) / 2."""
    return 100 * (n_a + n_b - differ) >= percent * (n_a + n_b + differ)


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    return enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent)


def enough(both: int, n_a: int, n_b: int, percent: int = PERCENT) -> bool:
    """Whether sets of these sizes with ``both`` common members link."""
    return 100 * both >= percent * (n_a + n_b - both)


def pack(low: np.ndarray) -> bytes:
    """Sorted 24-bit integers as 16-bit gaps (65535: no number yet) or, where that is longer, as they are."""
    gaps = np.diff(low, prepend=np.int64(0))
    skips = gaps // 65535
    if len(low) + int(skips.sum()) >= 2 * len(low):
        return b"\x00" + low.astype("<u4").tobytes()
    out = np.full(len(low) + int(skips.sum()), 65535, "<u2")
    out[np.cumsum(skips + 1) - 1] = gaps % 65535
    return b"\x01" + out.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if blob[:1] == b"\x00":
        return np.frombuffer(blob, "<u4", offset=1).astype(np.int64)
    gaps = np.frombuffer(blob, "<u2", offset=1).astype(np.int64)
    return np.cumsum(gaps)[gaps < 65535]


def packed_set(shingles: np.ndarray) -> bytes:
    """Sorted hashes, or the top bits of those of a larger set; the first byte tells which."""
    if len(shingles) <= SMALL_SET:
        return b"\x40" + shingles.tobytes()
    if len(shingles) <= LARGE_SET:
        return b"\x18" + pack(np.unique(shingles >> np.uint64(40)).astype(np.int64))
    return b"\x20" + np.unique(shingles >> np.uint64(32)).astype("<u4").tobytes()


def top_bits(blob: bytes, bits: int) -> np.ndarray:
    """The distinct top ``bits`` of a packed set's hashes, at most as many as it has."""
    has = blob[0]
    values = np.frombuffer(blob, np.uint64, offset=1) if has == 64 else \
        unpack(blob[1:]).astype(np.uint64) if has == 24 else np.frombuffer(blob, "<u4", offset=1).astype(np.uint64)
    return values if has == bits else np.unique(values >> np.uint64(has - bits))


def judged(n_a: int, a: bytes, n_b: int, b: bytes, percent: int = PERCENT) -> int:
    """1 if two packed sets of these sizes link, 0 if they don't, 2 if that takes their whole hashes."""
    bits = min(a[0], b[0])
    x, y = top_bits(a, bits), top_bits(b, bits)
    both = len(np.intersect1d(x, y, assume_unique=True))
    if bits == 64:
        return int(enough(both, n_a, n_b, percent))
    if not enough(both + min(n_a - len(x), n_b - len(y)), n_a, n_b, percent):
        return 0
    chance = max(n_a - both, 0) * max(n_b - both, 0) / 2.0 ** bits  # expected number of others that fall together
    return 1 if enough(both - MARGIN - int(np.ceil(8 * chance)), n_a, n_b, percent) else 2


def _grouped(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of the runs of a sorted array."""
    if len(keys):
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield int(keys[s]), s, e


def _shingled(df: DataFrame, n: int, run, schema: str) -> DataFrame:
    """``run(shingler, batches of (ids, texts))`` over (id, text)."""

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        yield from run(shingler, ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches))

    return df.select("id", "text").mapInArrow(call, schema)


#: Shingles that a worker of the counting step holds; sorting and packing take several times their 8 MB.
FLUSH_SHINGLES = 1_000_000


def survey(docs: DataFrame, n: int = N) -> tuple[DataFrame, Orders]:
    """One pass over all texts: (id, n, h1, h2) of every row, the size of its set and a 128-bit hash of it, and the orders
    from the counts of all shingles, with the at most ``HEAVY`` most frequent ones.

    Tasks send sorted shingles as packed gaps, cut in groups of about ``GROUP_SHINGLES``; a shingle is known by its group
    (top bits) and the next 24 bits, so that few are taken for another one.  Rows about documents travel along, packed
    as well, in groups of their own."""
    letters = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    group_bits = (letters // 6 // GROUP_SHINGLES).bit_length()
    shift = 64 - group_bits - 24

    def send(shingler, batches):
        held, about, size = [], [], 0

        def flush():
            rows = []
            if size:
                keys = np.sort(np.concatenate(held)) >> np.uint64(shift)
                low = (keys & np.uint64((1 << 24) - 1)).astype(np.int64)
                rows = [(g, pack(low[s:e])) for g, s, e in _grouped((keys >> np.uint64(24)).astype(np.int64))]
            if about:
                facts = np.array(about, np.int64)
                rows.append((-1 - int(facts[0, 0] & 0xFFFFFF) % (1 << group_bits), facts.tobytes()))
            held.clear()
            about.clear()
            return pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())],
                                              names=["g", "data"])

        for ids, texts in batches:
            for i, t in zip(ids, texts):
                own = shingler(t)
                held.append(own)
                size += len(own)
                sums = [int(mix64(own, seed).sum(dtype=np.uint64).view(np.int64)) for seed in (11, 12)] if len(own) else [0, 0]
                about.append((i or 0, i is not None, len(own), *sums))
            if size > FLUSH_SHINGLES:
                yield flush()
                size = 0
        yield flush()

    def read(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            facts = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 5) for b in pdf["data"]])
            ids = pd.Series(facts[:, 0], dtype="Int64").where(facts[:, 1] == 1)
            return pd.DataFrame({"id": ids, "n": facts[:, 2], "h1": facts[:, 3], "h2": facts[:, 4], "key": pd.Series([None] * len(facts), dtype="Int64")})
        low, counts = np.unique(np.concatenate([unpack(b) for b in pdf["data"]]), return_counts=True)
        often = counts > 2
        none = pd.Series([None] * int(often.sum()), dtype="Int64")
        return pd.DataFrame({"id": none, "n": counts[often], "h1": none, "h2": none, "key": low[often] + (int(key[0]) << 24)})

    found = written(_shingled(docs, n, send, "g long, data binary").groupBy("g").applyInPandas(
        read, "id long, n long, h1 long, h2 long, key long"))
    counts = found.where("key is not null").select("key", "n")
    least, kept = None, 0
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        kept += r["count"]
        if kept > HEAVY:
            break
        least = r["n"]
    rows = counts.where(F.col("n") >= (0 if least is None else least)).limit(HEAVY if least is not None else 0).toArrow()
    orders = Orders(rows.column("key").to_numpy().astype(np.uint64), rows.column("n").to_numpy(), shift)
    return found.where("key is null").select("id", "n", "h1", "h2"), orders


def postings(docs: DataFrame, orders, total: int, n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(t, id): first-order prefix postings of shingles in at least two prefixes, where ``t`` stands for the shingle; and
    (id, n, bits): size and bitmap of every set that isn't empty.

    Light shingles meet in groups by their top bits, where those of one document drop out.  Heavy ones, known to be
    frequent, are dealt out evenly instead, so a hot shingle never gathers in one group."""
    bits = max(0, (total // GROUP_SHINGLES).bit_length())
    groups, bitmap_groups = 1 << bits, -(1 << 40)

    def send(shingler, batches):
        own = orders.value
        held, about, size = [], [], 0

        def flush():
            rows = [(bitmap_groups - i % groups, data, np.array([i, size], np.int64).tobytes()) for i, size, data in about]
            if held:
                t = np.concatenate([x[0] for x in held]) >> np.uint64(2)  # 62 bits
                ids = np.concatenate([np.full(len(x[0]), x[2], np.int64) for x in held])
                heavy = np.concatenate([x[1] > 0 for x in held])
                g = (t >> np.uint64(62 - bits)).astype(np.int64) if bits else np.zeros(len(t), np.int64)
                spread = (mix64(ids.astype(np.uint64) ^ t, 3) % np.uint64(groups)).astype(np.int64)
                g = np.where(heavy, -1 - spread, g)
                order = np.lexsort((t, g))
                t, ids, g = t[order], ids[order], g[order]
                rows += [(k, t[s:e].tobytes(), ids[s:e].tobytes()) for k, s, e in _grouped(g)]
            held.clear()
            about.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["g", "t", "ids"])

        for ids, texts in batches:
            for i, text in zip(ids, texts):
                shingles = shingler(text)
                if len(shingles):
                    ((first, weight),) = own.prefixes(shingles, range(1), percent)
                    held.append((first, weight, i))
                    about.append((i, len(shingles), bitmap(shingles)))
                    size += len(first)
            if size > FLUSH_SHINGLES // 2:
                yield flush()
                size = 0
        yield flush()

    def meet(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] <= bitmap_groups:
            facts = np.array([np.frombuffer(b, np.int64) for b in pdf["ids"]])
            return pd.DataFrame({"t": pd.Series([None] * len(facts), dtype="Int64"), "id": facts[:, 0], "n": facts[:, 1], "bits": pdf["t"].to_numpy()})
        t = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["t"]]).astype(np.int64)
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["ids"]])
        if key[0] >= 0:
            order = np.argsort(t, kind="stable")
            t, ids = t[order], ids[order]
            same = t[1:] == t[:-1]
            keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            t, ids = t[keep], ids[keep]
        none = pd.Series([None] * len(t), dtype="object")
        return pd.DataFrame({"t": t, "id": ids, "n": none.astype("Int64"), "bits": none})

    found = written(_shingled(docs, n, send, "g long, t binary, ids binary").groupBy("g").applyInPandas(
        meet, "t long, id long, n long, bits binary"))
    return found.where("t is not null").select("t", "id"), found.where("t is null").select("id", "n", "bits")


def packed_sets(docs: DataFrame, pairs: DataFrame, orders, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(id, n, more, shingles) of the documents in ``pairs``: the set's size, its prefixes under the further orders as 32-bit
    hashes, and the packed set."""

    def run(shingler, batches):
        own = orders.value
        for ids, texts in batches:
            rows = []
            for i, text in zip(ids, texts):
                s = shingler(text)
                if len(s):
                    more = [(p & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for p, _ in own.prefixes(s, range(1, ORDERS), percent)]
                    rows.append((i, len(s), more, packed_set(s)))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["id", "n", "more", "shingles"])

    return written(_shingled(_of_pairs(docs, pairs), n, run, "id long, n long, more array<binary>, shingles binary"))


def whole_sets(docs: DataFrame, n: int = N) -> DataFrame:
    """(id, shingles) of the documents, as 64-bit hashes."""

    def run(shingler, batches):
        for ids, texts in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([shingler(t).tobytes() for t in texts], pa.binary())],
                                             names=["id", "shingles"])

    return _shingled(docs, n, run, "id long, shingles binary")


def _of_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    return keep_ids(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", "left_semi")


class Member(NamedTuple):
    """A member of a posting list; ``comp`` is 0 in the first round."""

    n: int
    id: int
    bits: int
    n_bytes: int
    comp: int


def _lists(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[Member]]]:
    """(keys, members) of the posting lists of a partition sorted by its first ``n_keys`` columns."""
    last, held = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns):
            key = row[:n_keys]
            if key != last:
                if len(held) > 1:
                    yield last, held
                last, held = key, []
            i, n, bits, *more = row[n_keys:]
            held.append(Member(n, i, int.from_bytes(bits, "big"), len(bits), *(more or (0,))))
    if len(held) > 1:
        yield last, held


def _near(p: Member, among: list[Member], percent: int = PERCENT) -> Iterator[int]:
    """Ids of those that may link with ``p``, by set sizes and bitmaps."""
    for m in among:
        if may_link(p.n, m.n, abs(p.n - m.n), percent) and may_link(p.n, m.n, distance(p.bits, p.n_bytes, m.bits, m.n_bytes), percent):
            yield m.id


def _pivot_pairs(t: int, members: list[Member], percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of ``PIVOTS`` members with all members.  Pivots are picked by a hash of the id and one of ``PIVOT_CLASSES`` of
    the list: lists that the same group of near copies fills share their pivots, and so their pairs."""
    if len(members) > PIVOTS + 1:
        order = mix64(np.array([m.id for m in members], np.int64).astype(np.uint64) * np.uint64(PIVOT_CLASSES) + np.uint64(t % PIVOT_CLASSES), 5)
        pivots = [members[i] for i in np.argpartition(order, PIVOTS)[:PIVOTS].tolist()]
    else:
        pivots = members
    for p in pivots:
        for i in _near(p, members, percent):
            if i != p.id:
                yield min(p.id, i), max(p.id, i)


def _open_pairs(members: list[Member], percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of members in different components.  Members are tried by rising set size, so a member meets only those
    within the size bound."""
    rising = sorted(members)
    for at, p in enumerate(rising):
        for m in rising[at + 1:]:
            if 100 * p.n < percent * m.n:
                break
            if m.comp != p.comp and m.id != p.id:
                for i in _near(p, [m], percent):
                    yield min(p.id, i), max(p.id, i)


def candidates(lists: DataFrame, n_keys: int, every: bool, percent: int = PERCENT) -> DataFrame:
    """(a, b), a < b, of posting lists (t, part..., id, n, bits[, comp]) in partitions sorted by the first
    ``n_keys`` columns; ``every``: all pairs whose components differ, else pairs with pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def flush() -> pa.RecordBatch:
            rows = sorted(seen)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for key, members in _lists(batches, n_keys):
            for pair in _open_pairs(members, percent) if every else _pivot_pairs(key[0], members, percent):
                seen.add(pair)
                if len(seen) >= FLUSH_PAIRS:
                    yield flush()
        yield flush()

    return lists.mapInArrow(run, "a long, b long").distinct()


def _with_both(pairs: DataFrame, own: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with ``columns`` of both sides, as ``<column>_a`` and ``<column>_b``."""
    side = lambda k: own.select(F.col("id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in columns])
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")


def _judge(joined: DataFrame, columns: list[str], judge) -> DataFrame:
    """(a, b, verdict) by ``judge(values of a, values of b)``, pairs of verdict 0 left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (zip(*(batch.column(f"{c}_{k}").to_pylist() for c in columns)) for k in ("a", "b"))
            verdicts = pa.array([judge(x, y) for x, y in zip(left, right)], pa.int32())
            kept = pa.array([v > 0 for v in verdicts.to_pylist()], pa.bool_())
            yield batch.select(["a", "b"]).append_column("verdict", verdicts).filter(kept)

    return joined.mapInArrow(run, "a long, b long, verdict int")


def verified(pairs: DataFrame, docs: DataFrame, orders, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The pairs that pass every further order's prefixes and whose sets link."""
    pairs = written(pairs)
    own = packed_sets(docs, pairs, orders, n, percent)

    def shares(a, b) -> int:
        return int(all(len(np.intersect1d(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))) for x, y in zip(a[0], b[0])))

    passed = _judge(_with_both(pairs, own, ["more"]), ["more"], shares)
    decided = written(_judge(_with_both(passed, own, ["n", "shingles"]), ["n", "shingles"], lambda a, b: judged(*a, *b, percent)))
    unsure = decided.where("verdict = 2").select("a", "b")
    exact = _judge(_with_both(unsure, whole_sets(_of_pairs(docs, unsure), n), ["shingles"]), ["shingles"],
                   lambda a, b: int(links(np.frombuffer(a[0], np.uint64), np.frombuffer(b[0], np.uint64), percent)))
    return decided.where("verdict = 1").select("a", "b").unionByName(exact.select("a", "b"))


def _parity(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmaps of one length, as rows of 64-bit words: several bits for each shingle of the largest set."""
    bits = 1 << min(max(max(map(len, sets)).bit_length() + 2, 6), 13)
    words = np.zeros((len(sets), bits // 64), np.uint64)
    at = mix64(np.concatenate(sets), 7) & np.uint64(bits - 1)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    np.bitwise_xor.at(words, (row, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return words


def _common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a set with others; none is empty."""
    every = np.concatenate(others)
    hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
    return np.add.reduceat(hit, np.cumsum([0, *map(len, others[:-1])]), dtype=np.int64)


def _part_links(pdf: pd.DataFrame, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (a, b) that join the components of members (id, comp, side, lists, shingles), fewer than there are components.

    Pairs are of one list and within a part (side 0), or of the first part (1) with the second (2).  A pair is
    compared unless the links found before it have joined its components."""
    pdf = pdf.sort_values(["side", "id"], ignore_index=True)
    ids, second, whole = pdf["id"].tolist(), pdf["side"].to_numpy() == 2, pdf["side"].iat[0] == 0
    root = np.unique(pdf["comp"], return_inverse=True)[1]
    sets = [np.frombuffer(b, np.uint64) for b in pdf["shingles"]]
    size, bits = np.array([len(s) for s in sets], np.int64), _parity(sets)
    codes, t = np.unique(np.concatenate(pdf["lists"].to_list()), return_inverse=True)
    owner = np.repeat(np.arange(len(ids)), [len(x) for x in pdf["lists"]])
    of_list = np.split(owner[np.argsort(t, kind="stable")], np.cumsum(np.bincount(t, minlength=len(codes)))[:-1])
    lists_of = np.split(t, np.cumsum([len(x) for x in pdf["lists"]])[:-1])
    found: list[tuple[int, int]] = []
    for x in range(int((~second).sum())):
        met = np.zeros(len(ids), bool)
        for k in lists_of[x].tolist():
            met[of_list[k]] = True
        met[:x + 1] = False
        near = np.flatnonzero(met & (root != root[x]) & (second | whole))
        low, both = np.minimum(size[near], size[x]), size[near] + size[x]
        fits = 100 * low >= percent * (both - low)
        near, both = near[fits], both[fits]
        differ = np.bitwise_count(bits[near] ^ bits[x]).sum(1, dtype=np.int64)
        near = near[100 * (both - differ) >= percent * (both + differ)]
        while len(near):
            some, near = near[:64], near[64:]
            common = _common(sets[x], [sets[i] for i in some])
            for i in some[100 * common >= percent * (size[some] + size[x] - common)].tolist():
                if root[i] != root[x]:
                    found.append((min(ids[x], ids[i]), max(ids[x], ids[i])))
                    root[root == root[i]] = root[x]
            near = near[root[near] != root[x]]
    return found


def joining_links(wide: DataFrame, docs: DataFrame, about: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(a, b) of verified links that join the components of each list of ``wide`` (t, id, comp).

    A large group whose members mostly don't link has a number of candidates that grows with its square.  So they aren't
    sent on: the sets come to the lists, and only links that join components leave the task.  A group of near copies
    fills many lists; those of one main component (the most frequent of a list) are compared together, so that
    a set travels once for them all.  Each is cut in parts by members and by shingles, and every two parts meet."""
    weighed = wide.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = written(weighed.groupBy("t").agg(F.max_by("comp", F.struct("c", F.xxhash64("comp"))).alias("main")))
    side = F.broadcast(main) if main.count() <= BROADCAST_ROWS else main
    members = written(wide.join(side, "t").groupBy("main", "id", "comp").agg(F.collect_list("t").alias("lists")))
    weight = members.join(about.groupBy("id").agg(F.sum("n").alias("n")), "id").groupBy("main").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    parts = written(weight.select("main", F.ceil(F.greatest(F.col("m") / LIST_ROWS, F.col("n") / PART_SHINGLES)).cast("int").alias("parts")))
    side = F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    met = members.join(side, "main").withColumn("part", own) \
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "main", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "id", "comp", "lists",
        F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"))
    sets = whole_sets(keep_ids(docs, members, "id", "left_semi"), n).where(F.length("shingles") > 0).distinct()
    links_of = lambda pdf: pd.DataFrame(_part_links(pdf, percent), columns=["a", "b"], dtype="int64")
    return met.join(sets, "id").groupBy("main", "p", "q").applyInPandas(links_of, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): the smallest id of its component.

    Rounds of large-star and small-star; each sends every neighbour to the smallest one, by a pre-aggregated minimum and
    a join, so a hub's neighbours are never gathered.  Rounds end when the edges are stars already."""
    stars = written(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")) \
            .select("e.*").where("v <> u").distinct()
        stars = written(small)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == mark:
            return stars.select(F.col("v").alias("id"), F.col("u").alias("root")).unionByName(
                stars.select(F.col("u").alias("id"), F.col("u").alias("root"))).distinct()
        mark = now


def ngram_jaccard_join(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """``key, n_shingles, component_id`` for every row: ``n`` words to a shingle, links from ``percent`` of Jaccard on."""
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sets, heavy = survey(docs, n)
    orders = spark.sparkContext.broadcast(heavy)
    full = sets.where(F.col("id").isNotNull() & (F.col("n") > 0))

    # classes of equal sets: only the smallest id of each goes on
    classes = written(full.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    side = F.broadcast(classes) if classes.count() <= BROADCAST_ROWS else classes
    placed = sets.join(side, ["h1", "h2", "n"], "left") \
        .select("id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "id")).otherwise(F.col("id")).alias("rep"))
    per_id = placed.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("rep").alias("low"), F.max(F.col("rep") == F.col("id")).alias("stays"))
    docs = docs.where(F.col("id").isNotNull())
    leaders = keep_ids(docs, per_id.where(~F.col("stays")), "id", "left_anti")

    total = full.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    posted, about = postings(leaders, orders, total, n, percent)
    posted = written(posted.distinct())

    # lists in parts of about LIST_ROWS members
    hot = written(posted.groupBy("t").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > LIST_ROWS)
                  .select("t", F.ceil(F.col("m") / LIST_ROWS).cast("int").alias("parts")))
    side = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    parts = F.coalesce("parts", F.lit(1))
    listed = posted.join(side, "t", "left").select("t", "id", parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    with_bits = listed.join(about, "id")
    size = posted.count()
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 16)

    lists = with_bits.select("t", "part", "id", "n", "bits").repartition(spread, "t", "part").sortWithinPartitions("t", "part")
    first = written(verified(candidates(lists, 2, False, percent), leaders, orders, n, percent))
    linked = components(first)

    # second round: every pair of a list across components; which lists have any is found before bitmaps or sets join in
    comp = posted.join(linked, "id", "left").select("t", "id", F.coalesce("root", "id").alias("comp"))
    mixed = written(comp.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
                    .where("lo <> hi").select("t", (F.col("m") > WIDE_LIST).alias("wide")))
    side = F.broadcast(mixed) if mixed.count() <= BROADCAST_ROWS else mixed
    open_ = comp.join(side, "t")
    lists = open_.where(~F.col("wide")).join(about, "id").select("t", "id", "n", "bits", "comp") \
        .repartition(spread, "t").sortWithinPartitions("t")
    again = written(verified(candidates(lists, 1, True, percent), leaders, orders, n, percent))
    if not mixed.where("wide").isEmpty():
        again = again.unionByName(written(joining_links(written(open_.where("wide").drop("wide")), leaders, about, n, percent)))
    orders.unpersist()

    same_id = placed.join(per_id.select("id", "low"), "id").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    every = linked.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(again).unionByName(same_id)
    found = components(every)
    return placed.join(found.select(F.col("id").alias("rep"), "root"), "rep", "left").select(
        F.col("id").cast(df.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))
