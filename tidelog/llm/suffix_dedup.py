"""Removal of repeated byte strings by a distributed sort of suffixes.

A suffix of a text stands for the byte string it leads with. In every `length` bytes the `GRAM` bytes with the least
hash make an anchor, so equal strings of that length have an anchor at the same place, and with it at least half of the
other bytes on one of its sides. A first round finds the anchors with a side that occurs again; it compares hashes, so
it may let an anchor through for nothing, but misses none. The others are on no repeated string.

The rest is exact, on bytes. For each anchor left, the suffix that begins there, and the bytes before it that a string
with this anchor can have, go to buckets: sampled splitters range-partition the suffixes by their leading bytes, buckets
are sorted by the suffixes, and a multikey sort of eight bytes at a time orders suffixes and what precedes them. Equal
ones are repeats from end to end. Those with the same leading bytes are compared string by string: hashes propose equal
strings, bytes confirm them. Splitters never part suffixes with equal leading bytes, and a bucket's last group waits for
the next batch, so no boundary lies between equal strings. Suffixes that are equal within a batch of texts are sent on
once; a group that is large even so isn't gathered, its strings are counted one by one all over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import GOLDEN, U64, bucketed, by_size, forget, free_name, map_batches, mix64, settled, with_free_names, with_rid

LENGTH, GRAM = 200, 32
#: Sets left sides' hashes apart from right ones'.
LEFT = U64(0x5555)
#: Bytes of text worked on at a time; bounds memory, not texts.
CHUNK = 1 << 18
#: Suffixes gathered to find equal ones before they are sent, and compared at a time.
GATHER, BLOCK = 1 << 15, 1 << 12
#: A group of more suffixes with the same leading bytes is counted string by string.
HOT = 1 << 14
BASE = 0x9E3779B97F4A7C15
BYTE = mix64(np.arange(1, 257, dtype=U64))
CHECK = mix64(np.arange(1001, 1257, dtype=U64))


class Powers:
    """BASE**i and BASE**-i modulo 2**64, as far as asked for."""

    up = down = np.ones(1, U64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            made = []
            for base in (BASE, pow(BASE, -1, 1 << 64)):
                x = np.full(2 * n, U64(base))
                x[0] = 1
                made.append(np.multiply.accumulate(x))
            cls.up, cls.down = made
        return cls.up[:n], cls.down[:n]


def prefix_sums(a: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Sums of bytes times powers from the begin of the last axis; their differences are hashes of what lies between."""
    out = np.zeros((*a.shape[:-1], a.shape[-1] + 1), U64)
    np.cumsum(table[a] * Powers.of(a.shape[-1])[0], axis=-1, out=out[..., 1:])
    return out


def hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of the string of width bytes that begins at each position; the same wherever it stands."""
    n = max(0, sums.shape[-1] - width)
    return mix64((sums[..., width:] - sums[..., :n]) * Powers.of(n)[1])


def least(x: np.ndarray, span: int) -> np.ndarray:
    """Where the least (leftmost of equals) of the span values from each position lies; fewer than 2**20 values."""
    m, width = ((x >> U64(20)) << U64(20)) | np.arange(len(x), dtype=U64), 1
    while 2 * width <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if span > width:
        m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
    return (m & U64((1 << 20) - 1)).astype(np.int64)


def cuts(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Chunks of text pieces: text, begin and end of the piece, and between which places the strings begin that are its own.

    Pieces overlap, so that every string and the sides of its anchor lie in one of them.
    """
    chunk, total = [], 0
    for i, n in enumerate(sizes):
        for at in range(0, max(n - length + 1, 0), CHUNK):
            stop = min(at + CHUNK, n - length + 1)
            begin, end = max(0, at - length), min(n, stop + 2 * length)
            chunk.append((i, begin, end, at, stop))
            total += end - begin
            if total >= CHUNK:
                yield chunk
                chunk, total = [], 0
    if chunk:
        yield chunk


def anchor_sides(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and side hash of the anchors of all strings of texts; an anchor may come twice."""
    side = GRAM + (length - GRAM) // 2
    for chunk in cuts([len(t) for t in texts], length):
        text, begin, end, at, stop = (np.array(x) for x in zip(*chunk, strict=True))
        sizes = end - begin
        starts = np.cumsum(sizes) - sizes
        a = np.frombuffer(b"".join(texts[i][b:e] for i, b, e, _, _ in chunk), np.uint8)
        sums = prefix_sums(a)
        where = least(hashes(sums, GRAM), length - GRAM + 1)
        own = np.zeros(len(where) + 1, np.int64)
        np.add.at(own, starts + at - begin, 1)
        np.add.at(own, starts + stop - begin, -1)
        where = np.unique(where[np.cumsum(own)[:-1] > 0])
        piece = np.searchsorted(starts, where, "right") - 1
        of_side = hashes(sums, side)
        right = where + side <= starts[piece] + sizes[piece]
        left = where - (side - GRAM) >= starts[piece]
        place = where - starts[piece] + begin[piece]
        yield text[piece[right]], place[right], of_side[where[right]]
        yield text[piece[left]], place[left], of_side[where[left] - (side - GRAM)] ^ LEFT


def packed_rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if i == 0 else pa.binary()) for i, x in enumerate(zip(*rows, strict=True))], names=names)


def ask_sides(length: int, buckets: int) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """Rows bucket, hash, rid, place (packed) of a batch of texts; hashes that occur twice in the batch go on once, with rid 0, and to buckets below 0 with all who have them."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, rid = b.column("text").cast(pa.binary()), b.column("rid").to_numpy()
        found = [(rid[i], place, h) for begin, part in several(texts) for own, place, h in anchor_sides(part, length) for i in [own + begin]]
        if not found:
            return
        owner, place, h = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(h)
        owner, place, h = owner[order], place[order].astype(np.uint32), h[order]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(starts, len(h)))
        again, first = np.repeat(sizes > 1, sizes), h[starts]
        part, mine = (first % U64(buckets)).astype(np.int64), np.where(sizes > 1, 0, owner[starts])
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(buckets + 1)).tolist()
        rows = [(k, *[x[order[s:e]].tobytes() for x in (first, mine, place[starts])]) for k, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s]
        if again.any():
            rows.append((-1 - int(first[0] % U64(buckets)), b"", owner[again].tobytes(), place[again].tobytes()))
        yield packed_rows(rows, ["bucket", "hash", "rid", "place"])

    return run


def several(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of at least CHUNK bytes together, with the number of the first."""
    begin, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n
        if size >= CHUNK or i == len(texts) - 1:
            yield begin, texts.slice(begin, i + 1 - begin).to_pylist()
            begin, size = i + 1, 0


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """rid, places: the anchors of each row's text (rid, text) with a side that occurs again, packed."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(t: pa.Table) -> pa.Table:
        rid, place = (np.frombuffer(b"".join(t.column(c).to_pylist()), k) for c, k in (("rid", np.int64), ("place", np.uint32)))
        if t.column("bucket")[0].as_py() >= 0:
            h = np.frombuffer(b"".join(t.column("hash").to_pylist()), U64)
            order = np.argsort(h)
            h, rid, place = h[order], rid[order], place[order]
            same = h[1:] == h[:-1]
            again = (np.append(False, same) | np.append(same, False)) & (rid != 0)
            rid, place = rid[again], place[again]
        part = (mix64(rid.view(U64)) % U64(n)).astype(np.int64)
        order = np.lexsort((rid, part))
        rid, place, part = rid[order], place[order], part[order]
        starts = np.flatnonzero(np.append(True, rid[1:] != rid[:-1])) if len(rid) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(rid))).astype(np.uint32)
        of, by = np.searchsorted(part, np.arange(n + 1)), np.searchsorted(part[starts], np.arange(n + 1))
        rows = [(k, rid[starts[by[k] : by[k + 1]]].tobytes(), counts[by[k] : by[k + 1]].tobytes(), place[of[k] : of[k + 1]].tobytes()) for k in range(n) if of[k + 1] > of[k]]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()), **{c: pa.array([r[i] for r in rows], pa.binary()) for i, c in enumerate(("rid", "n", "place"), 1)}})

    def by_owner(t: pa.Table) -> pa.Table:
        owners, counts, place = (np.frombuffer(b"".join(t.column(c).to_pylist()), k) for c, k in (("rid", np.int64), ("n", np.uint32), ("place", np.uint32)))
        rid = np.repeat(owners, counts)
        order = np.lexsort((place, rid))
        rid, place = rid[order], place[order]
        keep = np.append(True, (rid[1:] != rid[:-1]) | (place[1:] != place[:-1]))
        rid, place = rid[keep], place[keep]
        starts = np.flatnonzero(np.append(True, rid[1:] != rid[:-1]))
        return pa.table({"rid": pa.array(rid[starts]), "places": pa.array([place[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(rid)), strict=True)], pa.binary())})

    asked = map_batches(docs, ask_sides(length, n), "bucket bigint, hash binary, rid binary, place binary")
    told = asked.groupBy("bucket").applyInArrow(compare, "part bigint, rid binary, n binary, place binary")
    return settled(told.groupBy("part").applyInArrow(by_owner, "rid bigint, places binary"), "anchors")


def packed_texts(df: DataFrame) -> DataFrame:
    """rid and the text as compressed bytes, for the shuffle and the passes after it."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array((c.compress(t.as_py()) for t in b.column("text").cast(pa.binary())), pa.binary())], names=["rid", "packed"])

    return map_batches(df.select("rid", "text"), run, "rid bigint, packed binary")


def unpacked(b: pa.RecordBatch) -> Iterator[bytes]:
    d = zstandard.ZstdDecompressor()
    return (d.decompress(x.as_py()) for x in b.column("packed"))


class Suffixes:
    """Suffixes at anchors: bytes holds `span` bytes before the anchor and `length` from it on, zeros beyond the text.

    A string with the anchor begins low to high bytes before it. rid 0: nobody waits for the answer; twice: it occurs
    in two places at least.
    """

    FIELDS = ("bytes", "low", "high", "rid", "place", "twice")

    def __init__(self, length: int, *columns: np.ndarray):
        self.length, self.span = length, length - GRAM
        self.bytes, self.low, self.high, self.rid, self.place, self.twice = columns

    @classmethod
    def at(cls, data: bytes, rid: int, place: np.ndarray, length: int) -> Suffixes:
        span = length - GRAM
        a = np.frombuffer(bytes(span) + data + bytes(length), np.uint8)
        place = place.astype(np.int64)
        rows = np.lib.stride_tricks.sliding_window_view(a, span + length)[place]
        return cls(length, rows, np.maximum(0, length - (len(data) - place)), np.minimum(place, span), np.full(len(place), rid), place, np.zeros(len(place), bool))

    @classmethod
    def joined(cls, parts: list[Suffixes]) -> Suffixes:
        return cls(parts[0].length, *(np.concatenate([getattr(p, c) for p in parts]) for c in cls.FIELDS))

    @classmethod
    def read(cls, b: pa.RecordBatch, length: int) -> Suffixes:
        rows = np.frombuffer(b"".join(b.column("bytes").to_pylist()), np.uint8).reshape(b.num_rows, 2 * length - GRAM)
        return cls(length, rows, *(b.column(c).to_numpy(zero_copy_only=False) for c in cls.FIELDS[1:]))

    def take(self, at: np.ndarray | slice) -> Suffixes:
        return Suffixes(self.length, *(getattr(self, c)[at] for c in self.FIELDS))

    def __len__(self) -> int:
        return len(self.rid)

    def same(self) -> np.ndarray:
        """Whether each is the same as the one before it, text ends included."""
        return np.append(False, (self.bytes[1:] == self.bytes[:-1]).all(axis=1) & (self.low[1:] == self.low[:-1]) & (self.high[1:] == self.high[:-1])) if len(self) else np.zeros(0, bool)

    def leads(self) -> np.ndarray:
        """Where a group with the same leading bytes begins."""
        lead = self.bytes[:, self.span : self.span + GRAM]
        return np.flatnonzero(np.append(True, (lead[1:] != lead[:-1]).any(axis=1)))

    def batch(self, kind: int) -> pa.RecordBatch:
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(self.bytes.shape[1]), len(self), [None, pa.py_buffer(np.ascontiguousarray(self.bytes))]).cast(pa.binary())
        lead = [x.tobytes() for x in self.bytes[:, self.span : self.span + GRAM]]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(self), kind, np.int32)), pa.array(lead, pa.binary()), rows, *[pa.array(x) for x in (self.low, self.high, self.rid, self.place, self.twice)]], names=["kind", "lead", *self.FIELDS])


STORED = "kind int, lead binary, bytes binary, low bigint, high bigint, rid bigint, place bigint, twice boolean"


def collapsed(x: Suffixes) -> tuple[Suffixes, np.ndarray]:
    """One of each run of equal suffixes, and which of x (as it stands) are in a run of several or came as such."""
    starts = np.flatnonzero(~x.same())
    sizes = np.diff(np.append(starts, len(x)))
    many = np.logical_or.reduceat(x.twice, starts) | (sizes > 1)
    one = x.take(starts)
    one.twice, one.rid = many, np.where(many, 0, one.rid)
    return one, np.repeat(many, sizes)


def multikey(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the rows (bytes) within ascending groups; what is equal so far is sorted by the next eight bytes."""
    words = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view(">u8").astype(U64)
    order, tied = np.arange(len(rows)), np.arange(len(rows))
    for k in range(words.shape[1]):
        at = order[tied]
        key = words[at, k]
        sorted_ = np.lexsort((key, group[at]))
        at, key = at[sorted_], key[sorted_]
        order[tied] = at
        new = np.append(True, (key[1:] != key[:-1]) | (group[at][1:] != group[at][:-1]))
        group = group.copy()
        group[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]  # groups are numbered by place
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        if not len(tied):
            break
    return order


def spans(rid: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 1: what is repeated in a text, from place low to place high, overlaps within rid joined."""
    order = np.lexsort((begin, rid))
    rid, begin, end = rid[order], begin[order], end[order]
    if len(rid):  # ends are compared within a text only
        first = np.append(True, rid[1:] != rid[:-1])
        base = np.cumsum(first) * (int(end.max()) + 2)
        reach = np.maximum.accumulate(end + base)
        new = np.append(True, begin[1:] + base[1:] > reach[:-1]) | first
        at = np.flatnonzero(new)
        rid, begin, end = rid[at], begin[at], (reach - base)[np.append(at[1:], len(new)) - 1]
    n = len(rid)
    none = pa.nulls(n, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), none, none, pa.array(begin), pa.array(end), pa.array(rid), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())], names=STORED.replace(",", "").split()[::2])


def whole(x: Suffixes, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rid, begin and end of everything around these suffixes, for those who wait."""
    which = which & (x.rid != 0) & (x.low <= x.high)
    return x.rid[which], (x.place - x.high)[which], (x.place - x.low)[which] + x.length


def send_suffixes(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of kind 0 (suffixes to compare) and 1 (what is found repeated among the texts at hand)."""
    factors = mix64(np.arange(1, 1 + (2 * length - GRAM + 7) // 8, dtype=U64))

    def send(parts: list[Suffixes]) -> Iterator[pa.RecordBatch]:
        x = Suffixes.joined(parts)
        words = np.pad(x.bytes, ((0, 0), (0, -x.bytes.shape[1] % 8))).view(U64)
        x = x.take(np.argsort(words @ factors))  # brings equal ones together
        one, many = collapsed(x)
        yield spans(*whole(x, many))
        yield one.batch(0)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for data, rid, places in zip(unpacked(b), b.column("rid").to_pylist(), b.column("places").to_pylist(), strict=True):
            at = np.frombuffer(places, np.uint32)
            for i in range(0, len(at), GATHER):
                parts.append(Suffixes.at(data, rid, at[i : i + GATHER], length))
                size += len(parts[-1])
                if size >= GATHER:
                    yield from send(parts)
                    parts, size = [], 0
        if parts:
            yield from send(parts)

    return run


def compared(x: Suffixes) -> Iterator[pa.RecordBatch]:
    """What is repeated among suffixes that come in groups of equal leading bytes."""
    starts = x.leads()
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    order = multikey(np.concatenate((x.bytes[:, x.span :], x.bytes[:, : x.span]), axis=1), group)
    x, group = x.take(order), group[order]
    one, many = collapsed(x)
    found = [whole(x, many)]
    group = group[~x.same()]
    sizes = np.bincount(group)
    one = one.take(sizes[group] > 1)
    if len(one):
        found.append(by_string(one))
    yield spans(*(np.concatenate(c) for c in zip(*found, strict=True)))


def by_string(x: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rid, begin and end of the strings of x that begin as far before the anchor in another suffix; hashes propose, bytes confirm."""
    n, span, length = len(x), x.span, x.length
    before = span - np.arange(span + 1)  # of the strings by column
    real = (before >= x.low[:, None]) & (before <= x.high[:, None])
    flat = np.flatnonzero(real)
    key = (hashes(prefix_sums(x.bytes), length) + np.arange(span + 1, dtype=U64) * GOLDEN).ravel()[flat]
    order = np.argsort(key)
    key, flat = key[order], flat[order]
    same = np.append(False, key[1:] == key[:-1])
    other = np.full(n * (span + 1), -1, np.int64)
    again = np.flatnonzero(same)
    other[flat[again]] = flat[again - 1] // (span + 1)
    first = np.flatnonzero(~same & np.append(same[1:], False))
    other[flat[first]] = flat[first + 1] // (span + 1)
    other = other.reshape(n, span + 1)
    proposed = other >= 0
    run = proposed & np.append(np.ones((n, 1), bool), other[:, 1:] != other[:, :-1], axis=1)
    i, column = np.nonzero(run)
    if not len(i):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)  # equal bytes before and from the anchor
    for k in range(0, len(i), BLOCK):
        differ = x.bytes[i[k : k + BLOCK]] != x.bytes[other[i[k : k + BLOCK], column[k : k + BLOCK]]]
        ahead, back = differ[:, span:], differ[:, :span][:, ::-1]
        right[k : k + BLOCK] = np.where(ahead.any(axis=1), ahead.argmax(axis=1), length)
        left[k : k + BLOCK] = np.where(back.any(axis=1), back.argmax(axis=1), span)
    of = np.cumsum(run.ravel()).reshape(run.shape) - 1
    equal = proposed & (before <= left[of]) & (length - before <= right[of])
    for r, c in zip(*np.nonzero(proposed & ~equal), strict=True):  # equal hashes of different strings: look at all
        equal[r, c] = ((x.bytes[:, c : c + length] == x.bytes[r, c : c + length]).all(axis=1) & real[:, c]).sum() > 1
    mine = equal & (x.rid != 0)[:, None]
    edge = np.diff(np.pad(mine, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (row, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    start = x.place[row] - span
    return x.rid[row], start + a, start + b - 1 + length


def compare_sorted(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted suffixes, a partition at a time; the last group of a batch waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: Suffixes | None = None
        for b in batches:
            if not b.num_rows:
                continue
            x = Suffixes.read(b, length)
            x = x if rest is None else Suffixes.joined([rest, x])
            starts = x.leads()
            yield from blocks(x, starts.tolist())
            rest = x.take(slice(starts[-1], None))
        if rest is not None:
            yield from compared(rest)

    def blocks(x: Suffixes, edges: list[int]) -> Iterator[pa.RecordBatch]:
        begin = 0
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            if stop - begin > BLOCK and start > begin:
                yield from compared(x.take(slice(begin, start)))
                begin = start
        if edges[-1] > begin:
            yield from compared(x.take(slice(begin, edges[-1])))

    return run


def by_counting(suffixes: DataFrame, length: int) -> DataFrame:
    """What is repeated among the suffixes, by counts of single strings (128 bits of hash); the way for groups too large to gather."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = Suffixes.read(b, length)
        before = x.span - np.arange(x.span + 1)
        real = (before >= x.low[:, None]) & (before <= x.high[:, None])
        h = (hashes(prefix_sums(x.bytes), length) + np.arange(x.span + 1, dtype=U64) * GOLDEN)[real]
        check = hashes(prefix_sums(x.bytes, CHECK), length)[real]
        row = np.repeat(np.arange(len(x)), real.sum(axis=1))
        start = (x.place[:, None] - before)[real]
        order = np.lexsort((check, h))
        h, check, row, start = h[order], check[order], row[order], start[order]
        starts = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])))
        sizes = np.diff(np.append(starts, len(h)))
        many = np.logical_or.reduceat(x.twice[row], starts) | (sizes > 1)
        known = np.repeat(many, sizes) & (x.rid[row] != 0)
        rid = np.concatenate((np.where(many, 0, x.rid[row[starts]]), x.rid[row[known]]))
        zero = np.zeros(np.count_nonzero(known), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.concatenate((h[starts].view(np.int64), zero)), np.concatenate((check[starts].view(np.int64), zero)), np.concatenate((np.where(many, 2, 1), zero)), rid, np.concatenate((start[starts], start[known])))], names=["h", "check", "n", "rid", "begin"])

    rows = settled(map_batches(suffixes, run, "h bigint, check bigint, n bigint, rid bigint, begin bigint"), "strings")
    often = rows.filter("n > 0").groupBy("h", "check").agg(F.sum("n").alias("n")).filter("n > 1").select("h", "check")
    found = rows.filter("n = 0").unionByName(rows.filter("n = 1").join(often, ["h", "check"], "left_semi"))
    return found.select("rid", F.col("begin").alias("low"), (F.col("begin") + length).alias("high"))


def find_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """rid, begins, ends, kept: per distinct row (rid: with_rid) with something to remove, its maximal runs and remaining bytes.

    A text is shuffled once, if it has repeated anchors. hot: groups of more suffixes are counted string by string.
    """
    df = with_rid(docs).select("rid", "text").filter(F.octet_length("text") >= length)
    anchors = repeated_anchors(df, length)
    texts = bucketed(packed_texts(df.join(by_size(anchors.select("rid")), "rid", "left_semi")).join(anchors, "rid"), "texts", "rid")
    sent = settled(map_batches(texts.select("rid", "packed", "places"), send_suffixes(length), STORED), "suffixes")

    suffixes = sent.filter("kind = 0")
    large = settled(suffixes.groupBy(F.xxhash64("lead").alias("of")).count().filter(F.col("count") > hot).select("of"), "large")
    few = suffixes
    if not large.isEmpty():
        few = suffixes.join(by_size(large), F.xxhash64("lead") == F.col("of"), "left_anti")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = few.repartitionByRange(n, "lead").sortWithinPartitions("lead").select(*Suffixes.FIELDS)
    found = [sent.filter("kind = 1"), ordered.mapInArrow(compare_sorted(length), STORED)]
    found = [x.select("rid", "low", "high") for x in found]
    if few is not suffixes:
        found.append(by_counting(suffixes.join(by_size(large), F.xxhash64("lead") == F.col("of"), "left_semi").select(*Suffixes.FIELDS), length))
    runs = found[0]
    for x in found[1:]:
        runs = runs.unionByName(x)
    runs = runs.groupBy("rid").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))

    def cover(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for data, rid, low, high in zip(unpacked(b), *[b.column(c).to_pylist() for c in ("rid", "low", "high")], strict=True):
            order = np.argsort(low, kind="stable")
            low, high = np.array(low)[order], np.maximum.accumulate(np.array(high)[order])
            first = np.append(True, low[1:] > high[:-1])
            begins, ends = low[first].tolist(), high[np.append(first[1:], True)].tolist()
            out.append((rid, begins, ends, b"".join(data[e:s] for e, s in zip([0, *ends], [*begins, len(data)], strict=True))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], names=["rid", "begins", "ends", "kept"])

    found = map_batches(texts.join(runs, "rid").select("rid", "packed", "low", "high"), cover, "rid bigint, begins array<bigint>, ends array<bigint>, kept binary")
    done = settled(found.dropDuplicates(["rid"]), "repeats")
    forget(anchors, sent, large, texts)
    return done


def repeat_summary(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begins, ends): a row per row of docs.

    Each byte covered by a string of `length` bytes that begins anywhere else too, in any row or the same one, counts
    as removed; rows of one doc_id are different documents. A null text is empty; texts shorter than length lose
    nothing; other columns are ignored.
    """
    df = with_free_names(docs, ["doc_id", "text"]).withColumn("text", F.coalesce("text", F.lit("")))
    found = find_repeats(df, length)
    removed = F.aggregate(F.zip_with("begins", "ends", lambda s, e: e - s), F.lit(0).cast("bigint"), lambda x, y: x + y)
    found = found.select("rid", removed.alias("n_removed"), F.size("begins").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("sha"), "begins", "ends")
    whole = settled(with_rid(df).select("doc_id", "rid", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.encode("text", "utf-8"), 256).alias("own")), "digests")
    return whole.join(found, "rid", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"), "begins", "ends")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated strings cut out of text (a character cut in two goes whole) and n_chars, if present, brought up to date.

    Rows, their number and other columns, whatever their names, stay; a null text stays null.
    """
    found = find_repeats(docs.select("doc_id", "text"), length)
    rid, cut = free_name(docs, "rid"), free_name(docs, "cut")

    def decode(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array([x.decode("utf-8", "ignore") for x in b.column("kept").to_pylist()], pa.string())], names=[rid, cut])

    keyed = with_rid(docs, rid)
    ids = by_size(found.select(F.col("rid").alias(rid)))
    done = keyed.join(ids, rid, "left_semi").join(map_batches(found.select("rid", "kept"), decode, f"`{rid}` bigint, `{cut}` string"), rid).withColumn("text", F.col(cut))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return keyed.join(ids, rid, "left_anti").select(*names).unionByName(done.select(*names))
