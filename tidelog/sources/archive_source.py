"""Archives as a data source: spark.read.format("tidelog") and readStream, from explicit offsets and in offset order.

A task reads consecutive segments of one log, one after the other, so rows come in offset order without a sort or a
shuffle. Segments must be Parquet, on a file system that pyarrow.fs reaches; they are chosen by their names. Options:
path; starts, JSON of {topic: {partition: first offset}} (logs not named are left out; by default all from 0); first and
last, the offsets that a batch read wants of every log; task_bytes, segments of a task (default 128 MB, one at least).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidelog.schema import ENVELOPE, TIMESTAMP_TYPES

LAST = 2**63 - 1
NAME = re.compile(r"\+?(\d+)-\+?(\d+)\.parquet")
PLACE = re.compile(r"/_runs/_r=([^/]*)/_d=([^/]*)/_p=(\d+)/(?:_s=(\d+)-(\d+)/part-[^/]*|(\d+)-(\d+)\.parquet)$")


@dataclass
class Piece(InputPartition):
    """Segments of one log in order, and the offsets wanted of them."""

    topic: str
    number: int
    paths: list[str]
    first: int
    last: int

    def __init__(self, topic: str, number: int, paths: list[str], first: int, last: int):
        super().__init__(None)
        self.topic, self.number, self.paths, self.first, self.last = topic, number, paths, first, last


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self) -> StructType:
        return ENVELOPE

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ArchiveStream(self.options)


class Chains:
    """The logs of an archive and their segments, by names (or records) alone."""

    def __init__(self, options: dict[str, str]):
        self.store, self.root = fs.FileSystem.from_uri(options["path"])
        self.root, self.task_bytes = self.root.rstrip("/"), int(options.get("task_bytes", 128 << 20))
        starts = json.loads(options["starts"]) if "starts" in options else None
        self.starts = {(t, int(p)): int(o) for t, ps in starts.items() for p, o in ps.items()} if starts is not None else None

    def segments(self) -> dict[tuple[str, int], list[tuple[int, int, int, str]]]:
        """First and last offset, bytes and path of each log's segments, in order."""
        found: dict[tuple[str, int], list[tuple[int, int, int, str]]] = {}
        listed = self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        records = [x for x in listed if x.path.startswith(f"{self.root}/_commits/") and x.path.endswith(".json") and x.size]
        counted = set()
        for x in records:
            with self.store.open_input_file(x.path) as f:
                r = json.loads(f.read())
            counted.add((r["destination"], r["partition"], r["run"]))
        for x in listed:
            if x.type != fs.FileType.File:
                continue
            below = x.path.removeprefix(f"{self.root}/").split("/")
            if m := PLACE.search(x.path):
                log = (unquote(m[2]), int(m[3]))
                if (*log, m[1]) in counted:
                    found.setdefault(log, []).append((int(m[4] or m[6]), int(m[5] or m[7]), x.size, x.path))
            elif len(below) >= 3 and not below[0].startswith("_") and below[-2].isdigit() and (m := NAME.fullmatch(below[-1])):
                found.setdefault((below[-3], int(below[-2])), []).append((int(m[1]), int(m[2]), x.size, x.path))
        return {log: sorted(own) for log, own in found.items() if self.starts is None or log in self.starts}

    def start(self, log: tuple[str, int]) -> int:
        return 0 if self.starts is None else self.starts.get(log, 0)

    def pieces(self, found: dict[tuple[str, int], list[tuple[int, int, int, str]]], wanted: dict[tuple[str, int], tuple[int, int]]) -> list[Piece]:
        """The work of the offsets wanted (first, last) of each log in found, in runs of segments of some task_bytes."""
        out = []
        for log, own in sorted(found.items()):
            if log not in wanted:
                continue
            first, last = wanted[log]
            paths, size = [], 0
            for begin, end, n, path in own:
                if end < first or begin > last:
                    continue
                if paths and size + n > self.task_bytes:
                    out.append(Piece(*log, paths, first, last))
                    paths, size = [], 0
                paths.append(path)
                size += n
            if paths:
                out.append(Piece(*log, paths, first, last))
        return out

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(ENVELOPE)
        for path in piece.paths:
            with self.store.open_input_file(path) as f:
                for b in pq.ParquetFile(f).iter_batches(columns=ENVELOPE.fieldNames()):
                    t = pa.Table.from_batches([b])
                    offset = t["offset"].cast(pa.int64())
                    t = t.set_column(t.schema.get_field_index("offset"), "offset", offset)
                    t = t.filter(pc.and_(pc.greater_equal(offset, piece.first), pc.less_equal(offset, piece.last)))
                    kind = t["timestamp_type"]
                    known = pc.fill_null(pc.is_in(kind, value_set=pa.array(list(TIMESTAMP_TYPES.values()))), False)
                    t = t.set_column(t.schema.get_field_index("timestamp_type"), "timestamp_type", pc.if_else(known, kind, TIMESTAMP_TYPES[-1]))
                    headers = t["headers"].cast(schema.field("headers").type)
                    t = t.set_column(t.schema.get_field_index("headers"), "headers", pc.coalesce(headers, pa.scalar([], headers.type)))
                    yield from t.select(ENVELOPE.fieldNames()).cast(schema).to_batches()


class ArchiveReader(DataSourceReader):
    """Takes no filters from Spark: 4.1 keeps a reader with the filters of a first query for the next query of the same
    DataFrame, which would then lack rows. Ranges are options instead."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Piece]:
        chains = Chains(self.options)
        low, high = int(self.options.get("first", 0)), int(self.options.get("last", LAST))
        found = chains.segments()
        return chains.pieces(found, {log: (max(low, chains.start(log)), high) for log in found}) or [Piece("", 0, [], 0, -1)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return Chains(self.options).read(partition)


class ArchiveStream(DataSourceStreamReader):
    """Offsets are each log's next one; a chain counts as far as it has no gap."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def initialOffset(self) -> dict:
        chains = Chains(self.options)
        return {json.dumps(log): o for log, o in (chains.starts or {}).items()}

    def latestOffset(self) -> dict:
        chains, out = Chains(self.options), {}
        for log, own in chains.segments().items():
            upto = 0
            for begin, end, _, _ in own:
                if begin > upto:
                    break
                upto = max(upto, end + 1)
            out[json.dumps(log)] = max(upto, chains.start(log))
        return out

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        wanted = {tuple(json.loads(log)): (start.get(log, 0), upto - 1) for log, upto in end.items() if upto > start.get(log, 0)}
        chains = Chains(self.options)
        return chains.pieces(chains.segments(), wanted)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return Chains(self.options).read(partition)

    def commit(self, end: dict) -> None:
        pass


def register(spark) -> None:
    """Make the format "tidelog" known to the session."""
    spark.dataSource.register(ArchiveSource)
