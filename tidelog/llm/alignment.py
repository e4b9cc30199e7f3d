"""How the tokens of two tokenizers lie over each other.

Both tokenizers cut the same bytes, a blank and a text. Where tokens of both end, a group ends; two tokens are linked if
their bytes overlap. Everything is work on Arrow columns: tokens come as flattened lists with their parents' indices,
running sums of their lengths within a document give (document, end) keys, and a full outer hash join on these keys
gives every place where a token ends, in order: a key found on both sides ends a group, and each interval between two
such places lies in exactly one token of either side, so it is one link.

Counts of linked id pairs over the corpus come from Table.group_by's partial counts, a list per bundle of some megabytes
of text, added up by Spark. What the documents of a bundle link stays in the bundle's row; only the bundle's distinct
pairs are joined with the counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.chunks import LETTERS, Chunked, Remembered, Words, byte_alphabet, lists, load_tokenizer, packed, slices
from tidelog.llm.common import arrow_stream, release, settled, with_free_names

#: Text of a bundle (or one document), and chunks that are aligned at once.
MOST_TEXT, MOST_CHUNKS = 4 << 20, 600_000
#: Chunks whose tokens a worker remembers; results don't depend on it.
MOST_KNOWN = 400_000
END_BITS = 40
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


_WORD = re.compile(rf"( [{LETTERS}]+)([.,;:!?)*$%&#]*)")


class Pair:
    """The two tokenizers. Distinct chunks go through both; their tokens and whether the bytes come out right are kept."""

    def __init__(self, path_a: str, path_b: str):
        self.a = load_tokenizer(path_a, plain_specials=True)
        self.words_a = Words(self.a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab()
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            bytes_a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        self.lengths = tuple(pc.binary_length(table).to_numpy().astype(np.int64) for table in self.bytes)
        self.names = tuple(pa.array([str(i) for i in range(len(table))]) for table in self.bytes)
        self.remembered = Remembered(self._ask, MOST_KNOWN)

    def _ask_a(self, chunks: list[str]) -> list[list[int]]:
        """A plain word, and punctuation after it, go to the tokenizer's model, others through the whole tokenizer."""
        parts = [m.groups() if (m := _WORD.fullmatch(c)) else None for c in chunks]
        known = {x: self.words_a(x) if x else [] for x in {x for p in parts if p for x in p}}
        others = iter(self.a.encode_batch_fast([c for c, p in zip(chunks, parts, strict=True) if p is None], add_special_tokens=False))
        return [known[p[0]] + known[p[1]] if p else next(others).ids for p in parts]

    def _ask(self, chunks: list[str]) -> list[tuple[bytes, bytes, bool]]:
        found_a = packed(self._ask_a(chunks))
        found_b = packed(self.b.encode([c[1:] for c in chunks], num_threads=1) if chunks else [])
        data, right = pa.array(chunks, pa.string()).cast(pa.binary()), np.ones(len(chunks), bool)
        for found, table in zip((found_a, found_b), self.bytes, strict=True):
            ids = lists(found)
            joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values)), b"")
            right &= pc.equal(joined, data).to_numpy(zero_copy_only=False)
        return list(zip(found_a, found_b, right.tolist(), strict=True))


@cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _cuts(b: np.ndarray) -> np.ndarray:
    """Before a blank between other characters: no token of either tokenizer has both sides in it.

    A byte above 127 may end or begin a white space character, so one at most may stand beside the blank.
    """
    begins = np.zeros(len(b), bool)
    begins[1:-1] = (b[1:-1] == 32) & (b[:-2] > 32) & (b[2:] > 32) & ((b[:-2] < 128) | (b[2:] < 128))
    return begins


def _tokens(found: pa.ListArray, index: np.ndarray, doc_of_chunk: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> pa.Table:
    """key (document, end), id and place of the tokens of chunks. base: bytes of each document before these chunks."""
    taken = found.take(pa.array(index))
    ids = taken.flatten()
    doc = doc_of_chunk[pc.list_parent_indices(taken).to_numpy()]
    ends = pc.cumulative_sum(pa.array(lengths[ids.to_numpy()])).to_numpy()
    starts = np.flatnonzero(np.diff(doc, prepend=-1))  # the running sum starts anew with each document
    before = np.zeros(len(base), np.int64)
    before[doc[starts]] = np.where(starts, ends[starts - 1], 0)
    keys = (doc.astype(np.int64) << END_BITS) | (ends - before[doc] + base[doc])
    return pa.table({"key": pa.array(keys), "id": ids, "at": pa.array(np.arange(len(ids), dtype=np.int32))})


def _grouped(ids: pa.Array, names: pa.Array, last: np.ndarray) -> pa.Array:
    """The ids' names joined by commas, a string per group; last: each group's last token."""
    offsets = np.concatenate([[0], last + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(ids)), ",")


def aligned(both: Pair, chunked: Chunked, found: tuple[pa.ListArray, pa.ListArray], low: int, high: int, doc_of_chunk: np.ndarray, base: np.ndarray) -> tuple[pa.Table, pa.Table, pa.Array, np.ndarray]:
    """Chunks low..high-1 of right documents: documents' counts, (doc, pair, n) of their links, groups as text, their documents."""
    index, docs = chunked.index[low:high], doc_of_chunk[low:high]
    a, b = (_tokens(f, index, docs, n, base) for f, n in zip(found, both.lengths, strict=True))
    places = a.join(b, "key", join_type="full outer", right_suffix="_b", use_threads=False).combine_chunks()
    places = places.take(pc.sort_indices(places["key"]))
    doc = pc.shift_right(places["key"], END_BITS)
    meet = pc.and_(pc.is_valid(places["at"]), pc.is_valid(places["at_b"]))
    links = pa.table({"doc": doc, "pair": pc.bit_wise_or(pc.shift_left(pc.fill_null_backward(places["id"]).cast(pa.int64()), 32), pc.fill_null_backward(places["id_b"]).cast(pa.int64()))})
    links = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "n"])
    ends = places.filter(meet)
    groups = pc.binary_join_element_wise(*(_grouped(t["id"].combine_chunks(), names, ends[at].to_numpy()) for t, names, at in zip((a, b), both.names, ("at", "at_b"), strict=True)), "|")
    number = lambda column: pa.array(column, pa.int64())
    counted = pa.table({"doc": doc, "n_a": pc.is_valid(places["at"]).cast(pa.int64()), "n_b": pc.is_valid(places["at_b"]).cast(pa.int64()), "n_groups": meet.cast(pa.int64()), "n_links": number(np.ones(len(places), np.int64))})
    counted = counted.group_by("doc", use_threads=False).aggregate([(c, "sum") for c in COUNTS]).rename_columns(["doc", *COUNTS])
    return counted, links, groups, np.asarray(ends["key"].to_numpy()) >> END_BITS


def bundle(both: Pair, doc_ids: pa.Array, texts: pa.Array) -> tuple[pa.Table, pa.Table]:
    """Documents (doc_id, counts, groups_sha256, pairs and times as lists) and the distinct pairs with their counts."""
    chunked = Chunked(texts, _cuts, " ")
    known = both.remembered(chunked.distinct.to_pylist())
    found = lists([k[0] for k in known]), lists([k[1] for k in known])
    right = np.array([k[2] for k in known], bool)[chunked.index]
    n_docs, first = len(texts), chunked.first
    ends = np.concatenate([[0], np.cumsum(chunked.sizes, dtype=np.int64)])
    size = np.diff(ends[first])
    bad = np.add.reduceat(~right, first[:-1]) if len(right) else np.zeros(n_docs, np.int64)
    good = (size > 1) & (bad == 0)
    doc_of_chunk = np.repeat(np.arange(n_docs), np.diff(first))
    if not good.all():  # only right documents' chunks go on
        keep = good[doc_of_chunk]
        chunked.index, chunked.sizes, doc_of_chunk = chunked.index[keep], chunked.sizes[keep], doc_of_chunk[keep]
        ends = np.concatenate([[0], np.cumsum(chunked.sizes, dtype=np.int64)])
    starts = np.searchsorted(doc_of_chunk, np.arange(n_docs))
    counts, links, digests, low = [], [], {}, 0
    while low < len(doc_of_chunk):
        high = min(len(doc_of_chunk), low + MOST_CHUNKS)
        base = np.maximum(0, ends[low] - ends[starts])
        counted, linked, groups, docs = aligned(both, chunked, found, low, high, doc_of_chunk, base)
        counts.append(counted)
        links.append(linked)
        at = np.flatnonzero(np.diff(docs, prepend=-1))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(at, len(docs)).astype(np.int32)), groups), ";")
        for doc, text in zip(docs[at].tolist(), joined, strict=True):
            if doc in digests:
                digests[doc].update(b";")
            digests.setdefault(doc, hashlib.sha256()).update(text.as_buffer())
        low = high
    out = {c: np.zeros(n_docs, np.int64) for c in COUNTS}
    for t in counts:
        for c in COUNTS:
            np.add.at(out[c], t["doc"].to_numpy(), t[c].to_numpy())
    links = pa.concat_tables(links) if links else pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    if len(counts) > 1:
        links = links.group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "pair", "n"])
    totals = links.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
    order = pc.sort_indices(totals, [("n", "descending"), ("pair", "ascending")])
    totals = totals.take(order).combine_chunks()
    links = links.take(pc.sort_indices(links["doc"]))
    index = pc.index_in(links["pair"], value_set=totals["pair"].combine_chunks()).combine_chunks()
    offsets = pa.array(np.searchsorted(links["doc"].to_numpy(), np.arange(n_docs + 1)).astype(np.int32))
    documents = pa.table({"doc_id": doc_ids, **{c: pa.array(v) for c, v in out.items()}, "groups_sha256": pa.array([digests[i].hexdigest() if i in digests else "" for i in range(n_docs)], pa.string()), "pairs": pa.ListArray.from_arrays(offsets, index), "times": pa.ListArray.from_arrays(offsets, links["n"].combine_chunks().cast(pa.int32()))})
    return documents, totals


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of docs (doc_id, text).

    Each text, with a blank before it, is cut by tokenizer A (a tokenizers file of byte-level BPE) and by B (a
    sentencepiece model, which puts that blank there itself); special tokens' strings are plain text. n_best: links whose
    id pair is linked as often in the corpus as any with its B id; count_sum: the pairs' corpus counts over the links. A
    text that is null, empty, or that either tokenizer doesn't give back byte for byte has zeros and no digest. Every row
    counts, repeated ones too; other columns are ignored; no rows give no rows.
    """
    df = with_free_names(docs, ["doc_id", "text"])
    id_type = df.schema["doc_id"].dataType.simpleString()

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        try:
            for b in batches:
                for part in slices(b, "text", MOST_TEXT):
                    documents, totals = bundle(both, part.column("doc_id"), part.column("text"))
                    whole = lambda c: pa.ListArray.from_arrays(pa.array([0, len(totals)], pa.int32()), totals[c].combine_chunks())  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), whole("pair"), whole("n"), pa.array([arrow_stream(documents)], pa.binary())], names=["bundle", "pairs", "counts", "documents"])
                    n += 1
        finally:
            release()

    done = settled(df.mapInArrow(bundles, "bundle bigint, pairs array<bigint>, counts array<bigint>, documents binary"), "bundles")
    own = done.select("bundle", F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    totals = settled(own.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    token_b = F.col("pair").bitwiseAND((1 << 32) - 1)
    best = totals.groupBy(token_b.alias("b")).agg(F.max("n").alias("most"))  # a row per id of B at most
    rated = totals.withColumn("b", token_b).join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    looked_up = own.select(F.col("bundle").alias("of"), "pair").join(rated, "pair")

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for row in range(left.num_rows):
            t = pa.ipc.open_stream(left["documents"][row].as_buffer()).read_all()
            order = pc.index_in(left["pairs"][row].values, value_set=right["pair"].combine_chunks()).to_numpy()
            flat, times = t["pairs"].combine_chunks(), t["times"].combine_chunks()
            n, is_best = right["n"].to_numpy()[order], right["best"].to_numpy()[order]
            index, weight = flat.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(flat).to_numpy())])
            over = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])  # noqa: B023, E731
            columns = {"n_best": pa.array(over(weight * is_best[index])), "count_sum": pa.array(over(weight * n[index]))}
            found.append(pa.table({"doc_id": t["doc_id"], **{c: t[c] for c in COUNTS}, **columns, "groups_sha256": t["groups_sha256"]}))
        return pa.concat_tables(found) if found else pa.table({f.name: pa.array([], f.type) for f in result})

    result = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in [*COUNTS, "n_best", "count_sum"]], ("groups_sha256", pa.string())])
    schema = f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in [*COUNTS, "n_best", "count_sum"]) + ", groups_sha256 string"
    return done.select("bundle", "pairs", "documents").groupBy("bundle").cogroup(looked_up.groupBy("of")).applyInArrow(sums, schema)
