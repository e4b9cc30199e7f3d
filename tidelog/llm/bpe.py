"""Byte-level BPE: encoding by replaying the merges over a corpus of distinct words, and decoding.

Texts are cut into pieces by the tokenizer's pattern. Per batch of rows, the distinct new pieces form a corpus whose
tokens lie in one flat array. An inverted index holds, for every token pair that can merge, the positions where it
occurs; merges are applied in rank order, each over all its positions at once, and only the neighbours that a merge
touches get new index entries. A learned vocabulary seldom lets a merge give rise to an earlier one; the words in
which that happens are finished one by one, so that ids equal those of the usual lowest-rank-first loop.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidelog.llm.common import map_batches, with_free_names

NONE = np.int64(1 << 40)  # rank of a pair that does not merge
END = -1


def load_ranks(path: str) -> dict[bytes, int]:
    """The lines of a rank file: base64 of the token, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encodes lists of distinct pieces. Ids are ranks, as the public library assigns them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None:
                    pairs[(a << 24) | b] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.known = pairs

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.where((left >= 0) & (right >= 0), (left << 24) | right, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def one(self, ids: list[int]) -> list[int]:
        """Lowest rank first, leftmost of equals, over one word; a heap of pairs, so that a long word takes n log n steps."""
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.known.get((ids[i] << 24) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            if ids[at] != left or (other := nxt[at]) == n or ids[other] != right:
                continue  # one of the two has been merged since
            ids[at], ids[other], after = int(rank), END, nxt[other]
            nxt[at] = after
            if after < n:
                prv[after] = at
            for a, b in ((prv[at], at), (at, after)):
                if a >= 0 and b < n and (r := self.known.get((ids[a] << 24) | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [i for i in ids if i != END]

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers. A piece that is a token itself is that token."""
        out: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[i] = r.to_bytes(4, "little")
            elif p:
                rest.append(i)
            else:
                out[i] = b""
        if rest:
            for i, ids in zip(rest, self.replay([pieces[i] for i in rest]), strict=True):
                out[i] = ids
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        flat = np.frombuffer(b"".join(w + b"\0" for w in words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        tok = self.byte_ids[flat]
        tok[stops] = END  # ends each word and keeps its neighbours apart
        n = len(tok)
        word = np.repeat(np.arange(len(words)), lengths + 1)
        nxt = np.append(np.arange(1, n), n - 1)
        prv = np.arange(-1, n - 1)  # position -1 is the last word's end
        live = np.ones(n, bool)
        odd = np.zeros(len(words), bool)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(ranks: np.ndarray, at: np.ndarray) -> None:
            keep = ranks < NONE
            ranks, at = ranks[keep], at[keep]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(ranks)) + 1, [len(ranks)])).tolist()
            for r, a, b in zip(ranks[cuts[:-1]].tolist(), cuts[:-1], cuts[1:], strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(at[a:b])

        enter(self.rank_of(tok[:-1], tok[1:]), np.arange(n - 1))
        while heap:
            rank = heapq.heappop(heap)
            at = np.sort(np.concatenate(index.pop(rank)))
            at = at[live[at] & ~odd[word[at]] & np.append(True, at[1:] != at[:-1])]
            right = nxt[at]
            ok = self.rank_of(tok[at], tok[right]) == rank
            at, right = at[ok], right[ok]
            if not len(at):
                continue
            if len(at) > 1 and (right[:-1] == at[1:]).any():  # aaa: every second one, from the left
                chain = np.append(False, right[:-1] == at[1:])
                first = np.maximum.accumulate(np.where(chain, 0, np.arange(len(at))))
                keep = (np.arange(len(at)) - first) % 2 == 0
                at, right = at[keep], right[keep]
            before, after = prv[at], nxt[right]
            made = np.full(len(at), rank)
            # Were a pair made here of a lower rank, even for a moment, its word would need that merge first.
            low = np.minimum(self.rank_of(tok[before], made), self.rank_of(made, tok[after])) < rank
            if low.any():
                odd[word[at[low]]] = True
                keep = ~odd[word[at]]
                at, right, before, after = at[keep], right[keep], before[keep], after[keep]
                if not len(at):
                    continue
            tok[at] = rank
            live[right] = False
            nxt[at] = after
            prv[after] = at
            left_rank, right_rank = self.rank_of(tok[prv[at]], tok[at]), self.rank_of(tok[at], tok[nxt[at]])
            low = np.minimum(left_rank, right_rank) < rank
            if low.any():
                odd[word[at[low]]] = True
            enter(np.concatenate((left_rank, right_rank)), np.concatenate((prv[at], at)))
        live[stops] = False
        ids = tok[live].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word[live], minlength=len(words)))).tolist()
        out = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.one(self.byte_ids[np.frombuffer(words[i], np.uint8)].tolist()), "<u4").tobytes()
        return out


class Encoder:
    """Texts to ids by way of a cache of pieces; the cache is emptied when it has grown to `most` pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 200_000):
        self.replay, self.pattern, self.most, self.known = MergeReplay(ranks), regex.compile(pattern), most, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.known) > self.most:
            self.known = {}
        new = list(set(itertools.chain.from_iterable(split)).difference(self.known))
        for i in range(0, len(new), self.most):
            part = new[i : i + self.most]
            self.known.update(zip(part, self.replay.encode([p.encode() for p in part]), strict=True))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(load_ranks(path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = 3_000_000) -> DataFrame:
    """doc_id, ids: the text's ids as little-endian unsigned 32-bit integers.

    ranks_path must be readable on every executor. One output row per input row; a null or empty text has no ids;
    other columns are ignored. chunk_chars bounds the corpus of one replay, not any text.
    """

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(b, chunk_chars):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(encoder(ranks_path, pattern).encode(texts), pa.binary())], names=["doc_id", "ids"])

    df = with_free_names(docs, ["doc_id", "text"])
    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, data: the bytes that the ids stand for. Null ids give null bytes."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks_path, pattern)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array([None if x is None else e.decode(x) for x in b.column("ids").to_pylist()], pa.binary())], names=["doc_id", "ids", "data"])

    df = with_free_names(encoded, ["doc_id", "ids"])
    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids binary, data binary")


def chunks(b: pa.RecordBatch, chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Runs of rows (doc_id, texts) of about so many characters each; nulls become empty texts."""
    texts, begin, size = [x or "" for x in b.column("text").to_pylist()], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield b.column("doc_id").slice(begin, i + 1 - begin), texts[begin : i + 1]
            begin, size = i + 1, 0
