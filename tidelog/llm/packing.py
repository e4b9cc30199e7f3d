"""Packing of token ids into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of every document, 1 to window-1 ids, is
packed best-fit decreasing: longest first, each into the open window with the least room that still holds it. Pieces of
one length are interchangeable, so the placement is worked out once for the histogram of lengths, with runs of equal
windows instead of single ones. The histogram and the resulting placement are bounded by the window size and not by the
number of documents; each piece then finds its place from its length and its rank among the pieces of that length.
Windows that best fit leaves with more than max_gap free ids are laid end to end and cut anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.bpe import load_ranks
from tidelog.llm.common import settled, with_free_names

PART_BITS = 40


class RoomTree:
    """Segment tree over remaining capacities: finds the least capacity of at least `need` that has an open window."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.n = np.zeros(2 * self.leaves, np.int64)

    def add(self, room: int, windows: int) -> None:
        at = room + self.leaves
        while at:
            self.n[at] += windows
            at >>= 1

    def tightest(self, need: int) -> int | None:
        at = need + self.leaves
        if self.n[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.n[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at + (self.n[2 * at] == 0)
                return int(at - self.leaves)
            at >>= 1
        return None


def best_fit(histogram: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]], int]:
    """Placements (length, first rank, pieces, first window, offset), runs (first window, windows, fill) and the number of windows.

    Ranks first .. first+pieces-1 of a length lie at that offset of windows `first window` and on, one each.
    """
    tree, runs, placed, opened = RoomTree(window), {}, [], 0

    def leave(room: int, first: int, n: int) -> None:
        runs.setdefault(room, []).append((first, n))
        tree.add(room, n)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = window, opened, left
            else:
                first, n = runs[room].pop()
                tree.add(room, -n)
            layers = min(room // length, left)  # the window just filled is the tightest one for the next piece too
            used = min(n, left // layers)
            if room == window:
                opened += used
            elif used < n:
                leave(room, first + used, n - used)
            for j in range(layers):
                placed.append((length, rank, used, first, window - room + j * length))
                rank += used
            left -= layers * used
            leave(room - layers * length, first, used)
    return placed, [(first, n, window - room) for room, rs in runs.items() for first, n in rs], opened


class Places:
    """Where the pieces go. Holds as many numbers as best_fit made placements, however many pieces there are."""

    def __init__(self, histogram: dict[int, int], window: int, max_gap: int):
        placed, runs, self.windows = best_fit(histogram, window)
        placed = np.array(sorted(placed), np.int64).reshape(-1, 5)
        self.window, self.keys, self.placed = window, (placed[:, 0] << PART_BITS) | placed[:, 1], placed
        loose = sorted(r for r in runs if window - r[2] > max_gap and r[2] & (r[2] - 1))
        loose = np.array(loose, np.int64).reshape(-1, 3)
        self.first, self.n, self.fill = loose[:, 0], loose[:, 1], loose[:, 2]
        self.base = np.cumsum(self.n * self.fill) - self.n * self.fill

    def find(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, window, offset) of the parts of one piece."""
        _, first, _, at, offset = self.placed[np.searchsorted(self.keys, (length << PART_BITS) | rank, "right") - 1].tolist()
        window = at + rank - first
        run = int(np.searchsorted(self.first, window, "right")) - 1
        if run < 0 or window >= self.first[run] + self.n[run]:
            return [(0, length, window, offset)]
        pos = int(self.base[run] + (window - self.first[run]) * self.fill[run]) + offset
        out, start = [], 0
        while start < length:
            n = min(length - start, self.window - pos % self.window)
            out.append((start, n, self.windows + pos // self.window, pos % self.window))
            start, pos = start + n, pos + n
        return out


@cache
def tokenizer(path: str, pattern: str, specials: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    return tiktoken.Encoding(name="packing", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens=dict(specials))


def pack(docs: DataFrame, ranks_path: str, pattern: str, specials: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),), end_id: int = 0, window: int = 1024, max_gap: int = 64, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if keep_ids.

    Every row of docs is a document of its own, repeated doc_ids too; a null or empty text is the end id alone; other
    columns are ignored; no rows give no rows. ids are little-endian unsigned 32-bit integers, ids_crc32 their crc32.
    sequence_id is below 2**40 for packed windows and above for documents' full windows, and has no meaning beyond
    that. Ids are those of the tokenizer file of the same vocabulary; the rank file is used because its library
    encodes several times as fast. One pass over the texts; only rests of documents are shuffled.
    """
    df = with_free_names(docs, ["doc_id", "text"])
    id_type = df.schema["doc_id"].dataType.simpleString()
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("part", pa.int64()), ("nth", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, part, seen = tokenizer(ranks_path, pattern, specials), TaskContext.get().partitionId(), [0] * (window + 1)
        for b in batches:
            row, cols = [], [[] for _ in fields]
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = np.append(t.encode_to_numpy(text or "", allowed_special="all"), np.uint32(end_id)).astype("<u4")
                data, n = ids.tobytes(), len(ids)
                for start in range(0, n, window):
                    own, length = data[4 * start : 4 * (start + window)], min(window, n - start)
                    row.append(i)
                    for c, v in zip(cols, (start, length, zlib.crc32(own), n, own if keep_ids or length < window else None, part, seen[length]), strict=True):
                        c.append(v)
                    seen[length] += 1
            if row:
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), *[pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)]], names=["doc_id", *[n for n, _ in fields]])

    pieces = settled(df.mapInArrow(cut, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, part bigint, nth bigint"), "pieces")
    rests = pieces.filter(F.col("length") < window)
    counts = rests.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(histogram, window, max_gap)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = rests.join(counts.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("nth", F.col("before") + F.col("nth")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "nth")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, cols = [], [[] for _ in range(7)]
            for i, (start, length, crc, n, ids, nth) in enumerate(zip(*[b.column(c).to_pylist() for c in ("start", "length", "ids_crc32", "doc_tokens", "ids", "nth")], strict=True)):
                for skip, size, sequence, offset in places.find(length, nth):
                    own = ids[4 * skip : 4 * (skip + size)]
                    row.append(i)
                    for c, v in zip(cols, (start + skip, size, crc if size == length else zlib.crc32(own), n, sequence, offset, own if keep_ids else None), strict=True):
                        c.append(v)
            if row:
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), *[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.binary())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    packed = ranked.mapInArrow(place, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
    full = pieces.filter(F.col("length") == window).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.shiftleft(F.col("part") + 1, PART_BITS) + F.col("nth")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), "ids")
    out = full.unionByName(packed)
    return out if keep_ids else out.drop("ids")
