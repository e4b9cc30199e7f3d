"""Token ids in files of bit planes, with an index that finds any id.

A file holds the ids of a run of documents. They are cut into blocks of a fixed number of ids; a block is transposed, so
that bit (or byte) 0 of all its ids comes first, then bit 1 of all, and each of these planes is compressed with
zstandard on its own; planes that no id of the block uses aren't stored. Behind the blocks lie the documents (id and
number of tokens) and the chunk index (per block: the ids before it, its ids, where its planes are and their lengths, a
crc32), both as compressed Arrow streams, and a tail of fixed length that says where they begin.

Files are written by tasks, each to a name of its own first and then moved, so a task that runs again leaves the same
file. The folder must be one that all machines reach and pyarrow.fs knows (shared or distributed files, object stores).
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.chunks import LETTERS, Chunked, Remembered, Words, after_letters, lists, load_tokenizer, packed, slices
from tidelog.llm.common import arrow_stream, release, with_free_names

MAGIC, TAIL = b"IDPLANES", struct.Struct("<QQQQ8s")
INDEX = pa.schema([("first", pa.int64()), ("n", pa.int32()), ("at", pa.int64()), ("sizes", pa.list_(pa.int32())), ("crc", pa.int64())])
#: Text that is encoded at once, and ids that a reader gathers before it passes documents on.
MOST_TEXT, MOST_IDS = 8 << 20, 2 << 20


class Layout(NamedTuple):
    """block: ids per block; planes: `bit` or `byte`; level: zstandard's."""

    block: int = 1 << 16
    planes: str = "bit"
    level: int = 3


# -- blocks --------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, planes: str) -> list[np.ndarray]:
    """The used planes of 32-bit ids, lowest first."""
    width = max(1, -(-int(ids.max()).bit_length() // 8)) if len(ids) else 1
    rows = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :width]
    if planes == "byte":
        return [np.ascontiguousarray(rows[:, i]) for i in range(width)]
    used = int(ids.max()).bit_length() if len(ids) else 0
    return [np.packbits(rows[:, i // 8] >> (i % 8) & 1, bitorder="little") for i in range(used)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for i, p in enumerate(planes):
        p = np.frombuffer(p, np.uint8)
        own = p if kind == "byte" else np.unpackbits(p, count=n, bitorder="little")
        out |= own.astype(np.uint32) << np.uint32(8 * i if kind == "byte" else i)
    return out


class BlockFile:
    """Writes one file: ids as they come, cut into blocks."""

    def __init__(self, out, layout: Layout):
        self.out, self.layout, self.zstd = out, layout, zstandard.ZstdCompressor(level=layout.level)
        self.waiting, self.n_waiting, self.n_ids, self.index = [], 0, 0, []
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.layout.block:
            whole, size = np.concatenate(self.waiting), self.layout.block
            full = len(whole) // size * size
            for i in range(0, full, size):
                self._block(whole[i : i + size])
            self.waiting, self.n_waiting = [whole[full:].copy()], len(whole) - full

    def _block(self, ids: np.ndarray) -> None:
        found = [self.zstd.compress(p.tobytes()) for p in to_planes(ids, self.layout.planes)]
        self.index.append((self.n_ids, len(ids), self.at, [len(p) for p in found], zlib.crc32(ids.astype("<u4").tobytes())))
        for p in found:
            self.out.write(p)
            self.at += len(p)
        self.n_ids += len(ids)

    def close(self, documents: pa.RecordBatch) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        columns = list(zip(*self.index, strict=True)) or [[]] * len(INDEX)
        index = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, INDEX, strict=True)], schema=INDEX)
        docs, blocks = arrow_stream(documents), arrow_stream(index.replace_schema_metadata({"planes": self.layout.planes}))
        for part in (docs, blocks, TAIL.pack(self.at, self.at + len(docs), self.n_ids, documents.num_rows, MAGIC)):
            self.out.write(part)


class OpenFile:
    """Reads one file: its documents, and any block by the chunk index."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        docs_at, index_at, self.n_ids, self.n_docs, magic = TAIL.unpack(file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of id planes")
        both = file.read_at(size - TAIL.size - docs_at, docs_at)
        self.documents = pa.ipc.open_stream(both[: index_at - docs_at]).read_next_batch()
        index = pa.ipc.open_stream(both[index_at - docs_at :]).read_next_batch()
        self.planes = index.schema.metadata[b"planes"].decode()
        self.first, self.n, self.at, self.crc = (index.column(c).to_numpy() for c in ("first", "n", "at", "crc"))
        self.sizes = index.column("sizes")
        self.zstd = zstandard.ZstdDecompressor()

    def block(self, i: int) -> np.ndarray:
        """The ids of block i; a block that isn't what was written is an error."""
        sizes = self.sizes[i].as_py()
        data, planes, at = self.file.read_at(sum(sizes), int(self.at[i])), [], 0
        for n in sizes:
            planes.append(self.zstd.decompress(data[at : at + n]))
            at += n
        ids = from_planes(planes, int(self.n[i]), self.planes)
        if zlib.crc32(ids.astype("<u4").tobytes()) != int(self.crc[i]):
            raise ValueError(f"block {i} is damaged")
        return ids

    def range(self, first: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first, ids) of the parts of ids first..end-1 of the file, a block each; no other block is read."""
        for i in range(int(np.searchsorted(self.first, first, "right")) - 1 if len(self.first) else 0, len(self.first)):
            if self.first[i] >= end:
                return
            low, high = max(first - int(self.first[i]), 0), min(end - int(self.first[i]), int(self.n[i]))
            if low < high:
                yield int(self.first[i]) + low, self.block(i)[low:high]


# -- tables --------------------------------------------------------------------------------------------------------


_BLANK, _MARK = (np.array([chr(b) in found for b in range(256)]) for found in (" \n", ".,;:!?)*$%&#"))
_WORD = re.compile(rf"[ \n]?([{LETTERS}]+)")


def _cuts(b: np.ndarray) -> np.ndarray:
    """Before blanks and line ends, and before punctuation after a plain letter or digit: no token, and nothing that the
    tokenizer normalises or takes as one word, has both sides in it."""
    return _BLANK[b] | _MARK[b] & after_letters(b)


_KNOWN: dict[str, Remembered] = {}


def _encoder(path: str) -> Remembered:
    """Chunks that are one plain word go to the tokenizer's model in lower case, others through the whole tokenizer."""
    if path in _KNOWN:
        return _KNOWN[path]
    tokenizer = load_tokenizer(path, plain_specials=False)
    of_word = Words(tokenizer)

    def ask(new: list[str]) -> list[bytes]:
        words = [m[1].lower() if (m := _WORD.fullmatch(c)) else None for c in new]
        known = {w: of_word(w) for w in set(words) if w is not None}
        others = iter(tokenizer.encode_batch_fast([c for c, w in zip(new, words, strict=True) if w is None], add_special_tokens=False))
        return packed([next(others).ids if w is None else known[w] for w in words])

    return _KNOWN.setdefault(path, Remembered(ask))


def encode(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' ids end to end, each text's followed by end_id, and the number of each (with that id)."""
    chunked = Chunked(texts, _cuts)
    found = lists(_encoder(path)(chunked.distinct.to_pylist()))
    ids = found.take(pa.array(chunked.index)).flatten().to_numpy()
    lengths = pc.list_value_length(found).to_numpy()[chunked.index]
    counts = np.diff(np.concatenate([[0], np.cumsum(lengths)])[chunked.first])
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, layout: Layout = Layout()) -> DataFrame:
    """Write the ids of docs (doc_id, text), each text's followed by end_id, below folder; returns the table of files.

    Documents are in ascending order of doc_id (null first; of equal ids by their texts), over files too: a file is a
    range of that order. A null text is an empty one; rows that repeat are written each; no rows leave no files. Columns:
    part, file, n_docs, n_ids, n_bytes. The table of files is written last, in folder/files, so a folder without it isn't
    complete. The tokenizer is a file of byte-level BPE that lowers case and drops white space. Special tokens' strings in
    texts are what the file makes of them.
    """
    df = with_free_names(docs, ["doc_id", "text"])
    root = folder.rstrip("/")
    by_text = F.xxhash64("text")
    dealt = df.repartitionByRange("doc_id", by_text).sortWithinPartitions("doc_id", by_text, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, ids_of_docs, counts_of_docs, file, out = TaskContext.get(), [], [], None, None
        store, path = fs.FileSystem.from_uri(root)
        name = f"part-{context.partitionId():07d}.ids"
        own = f"{path}/.{name}.{context.taskAttemptId()}"
        try:
            for b in batches:
                for part in slices(b, "text", MOST_TEXT):
                    if file is None:
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(own)
                        file = BlockFile(out, layout)
                    ids, counts = encode(part.column("text"), tokenizer_path, end_id)
                    file.add(ids)
                    ids_of_docs.append(part.column("doc_id"))
                    counts_of_docs.append(pa.array(counts, pa.int64()))
            if file is not None:
                documents = pa.RecordBatch.from_arrays([pa.concat_arrays(ids_of_docs), pa.concat_arrays(counts_of_docs)], names=["doc_id", "n_tokens"])
                file.close(documents)
                out.close()
                store.move(own, f"{path}/{name}")
                size = store.get_file_info(f"{path}/{name}").size
                yield pa.RecordBatch.from_pydict({"part": [context.partitionId()], "file": [name], "n_docs": [documents.num_rows], "n_ids": [file.n_ids], "n_bytes": [size]})
        finally:
            release()

    schema = "part bigint, file string, n_docs bigint, n_ids bigint, n_bytes bigint"
    dealt.mapInArrow(write, schema).write.parquet(f"{root}/files")
    return df.sparkSession.read.schema(schema).parquet(f"{root}/files")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """The table of files with start, the ids of all files before; a row per file."""
    found = spark.read.parquet(f"{folder.rstrip('/')}/files")
    return found.withColumn("start", F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_ids(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids (packed little-endian unsigned 32-bit) of the documents in folder's files.

    start: the ids of all documents before. A file is read block by block, several documents at a time.
    """
    root, found = folder.rstrip("/"), files(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(root)
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{path}/{name}") as f:
                    file = OpenFile(f)
                    counts = file.documents.column("n_tokens").to_numpy()
                    ends, doc = np.cumsum(counts), 0
                    while doc < len(counts):
                        first = int(ends[doc - 1]) if doc else 0
                        upto = max(doc + 1, int(np.searchsorted(ends, first + MOST_IDS, "right")))
                        ids = np.concatenate([x for _, x in file.range(first, int(ends[upto - 1]))] or [np.zeros(0, np.uint32)])
                        offsets = np.concatenate([[0], ends[doc:upto] - first])
                        data = pa.Array.from_buffers(pa.binary(), upto - doc, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                        yield pa.RecordBatch.from_arrays([file.documents.column("doc_id").slice(doc, upto - doc), pa.array(start + first + offsets[:-1], pa.int64()), pa.array(counts[doc:upto], pa.int64()), data], names=["doc_id", "start", "n_tokens", "ids"])
                        doc = upto
        release()

    return found.select("file", "start").repartition(max(1, found.count())).mapInArrow(read, f"doc_id {id_type}, start bigint, n_tokens bigint, ids binary")


def read_range(spark: SparkSession, folder: str, first: int, n: int) -> DataFrame:
    """start, ids of the parts that ids first .. first+n-1 lie in; other files aren't opened, other blocks not read."""
    root = folder.rstrip("/")
    found = files(spark, folder).filter((F.col("start") < first + n) & (F.col("start") + F.col("n_ids") > first))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(root)
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{path}/{name}") as f:
                    for at, ids in OpenFile(f).range(max(first - start, 0), first + n - start):
                        yield pa.RecordBatch.from_pydict({"start": pa.array([start + at], pa.int64()), "ids": pa.array([ids.astype("<u4").tobytes()], pa.binary())})

    return found.select("file", "start").mapInArrow(read, "start bigint, ids binary")
