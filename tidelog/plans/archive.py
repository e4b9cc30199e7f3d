"""Writing segments, committing them in order, reading them back."""

from __future__ import annotations

import itertools
import os
import re
import shutil
import time
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.columns import parsed_name
from tidelog.operators.chains import catalogue, list_files
from tidelog.plans import records
from tidelog.plans.storage import Files, plain
from tidelog.schema import ENDINGS, ENVELOPE
from tidelog.sources.log import normalised

STAGING = "_staging"
#: Fixed value: the folder that Spark's writer gives a destination without a name.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
SEGMENT = re.compile(rf"(\d+)-(\d+)\.(?:{'|'.join(re.escape(x) for x in ENDINGS.values())})")
#: Codec names of the archive and what Spark calls them (and Arrow, without _raw).
CODECS = {"zstd": "zstd", "snappy": "snappy", "lz4": "lz4_raw", "uncompressed": "none"}


def ndjson_line() -> Column:
    """One compact JSON object in envelope order; nulls and empty headers are left out, payloads are base64."""
    fields = [c for c in ENVELOPE.fieldNames() if c != "headers"]
    return F.to_json(F.struct(*fields, F.when(F.size("headers") > 0, F.col("headers")).alias("headers")))


def stage_segments(rows: DataFrame, root: str, fmt: str = "parquet", codec: str = "zstd", by_record: bool | None = None) -> str:
    """Write rows (envelope, destination, from_offset, to_offset) below root, one file per segment; returns the folder.

    Segments are dealt to tasks whole and each task writes its segments one by one in offset order. by_record: the
    folder is a run's, where its segments stay (see records; default: what the archive is, or the file system needs);
    else it is in the staging folder. On folders of the file system tasks write the files themselves (see
    written_segments): Spark's writer takes far longer to open and close a file than small segments take to write. On
    stores, which it alone reaches, it writes a folder per segment.
    """
    spark = rows.sparkSession
    if by_record is None:
        by_record = records.kept_by_records(spark, root)
    run = uuid.uuid4().hex
    folder = records.run_folder(root, run) if by_record else f"{root.rstrip('/')}/{STAGING}/{run}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: files take time however little is in them
    segment = ["destination", "partition", "from_offset"]
    dealt = rows.repartition(tasks, *segment).sortWithinPartitions(*segment, "offset")
    columns = [ndjson_line().alias("value")] if fmt == "ndjson" else ENVELOPE.fieldNames()
    if Files(spark, root).local:
        keyed = dealt.select(F.struct(*columns).alias("row"), *(F.col(c).alias(f"_{c}") for c in (*segment, "to_offset")))
        keyed.mapInArrow(written_segments(plain(folder), fmt, codec), "n bigint").agg(F.sum("n")).collect()
        return folder
    keys = {"_d": F.col("destination"), "_p": F.col("partition"), "_s": F.format_string("%020d-%020d", "from_offset", "to_offset")}
    # Tasks put their files in place themselves: nobody reads the folder before the job has ended, and a task that is run again writes the same names.
    writer = dealt.withColumns(keys).select(*columns, *keys).write.partitionBy(*keys).option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("maxRecordsPerFile", 0)
    if fmt == "ndjson":
        writer.text(folder)
    else:
        writer.option("compression", CODECS[codec]).parquet(folder)
    return folder


def folder_value(text: str | None) -> str:
    """text as the value in a folder's name, so that Spark's readers get it back: they decode characters, not bytes."""
    return re.sub(r"[\x00-\x7f]+", lambda m: quote(m[0], safe=""), text) if text else NO_NAME


class SegmentFile:
    """A segment's file in a chain's folder of a run; it has a hidden name, of this attempt alone, until it is whole."""

    def __init__(self, folder: str, key: tuple, fmt: str, codec: str, group_bytes: int):
        destination, partition, first, last = key
        self.key, self.fmt, self.codec, self.group_bytes = key, fmt, codec, group_bytes
        chain = os.path.join(folder, f"_d={folder_value(destination)}", f"_p={partition}")
        os.makedirs(chain, exist_ok=True)
        self.target, self.own = os.path.join(chain, f"{first:020d}-{last:020d}.{ENDINGS[fmt]}"), os.path.join(chain, f".{first}-{uuid.uuid4().hex}")
        self.out, self.writer, self.held, self.size = pa.OSFile(self.own, "wb"), None, [], 0

    def add(self, rows: pa.StructArray, size: int) -> None:
        self.held.append(rows)
        self.size += size
        if self.size >= self.group_bytes:
            self._write()

    def _write(self) -> None:
        t = pa.Table.from_batches([pa.RecordBatch.from_struct_array(r) for r in self.held])
        if self.fmt == "ndjson":
            self.out.write("".join(f"{line}\n" for line in t["value"].to_pylist()).encode())
        else:
            if self.writer is None:
                self.writer = pq.ParquetWriter(self.out, t.schema, compression=CODECS[self.codec].removesuffix("_raw"), use_dictionary=["topic", "timestamp_type"], store_schema=False)
            self.writer.write_table(t, row_group_size=max(1, t.num_rows))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._write()
        if self.writer is not None:
            self.writer.close()
        self.out.close()
        os.rename(self.own, self.target)


def written_segments(folder: str, fmt: str, codec: str, group_bytes: int = 64 << 20):
    """Writes rows, which come segment after segment, to folder/_d=<destination>/_p=<partition>/<first>-<last>.<ending>.

    Rows of some group_bytes are held at a time, so a segment may be of any size.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            each = max(1, b.nbytes // b.num_rows)
            codes = b["_destination"].dictionary_encode()
            columns = [codes.indices.fill_null(-1), b["_partition"].fill_null(-1), b["_from_offset"], b["_to_offset"]]
            numbers = [c.to_numpy(zero_copy_only=False) for c in columns]
            starts = np.flatnonzero(np.any([np.diff(c) != 0 for c in numbers], axis=0)) + 1
            for begin, end in itertools.pairwise([0, *starts.tolist(), b.num_rows]):
                key = (b["_destination"][begin].as_py(), b["_partition"][begin].as_py(), int(numbers[2][begin]), int(numbers[3][begin]))
                if current is None or current.key != key:
                    if current is not None:
                        current.close()
                    current, n = SegmentFile(folder, key, fmt, codec, group_bytes), n + 1
                current.add(b["row"].slice(begin, end - begin), each * (end - begin))
        if current is not None:
            current.close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return write


def commit_segments(spark: SparkSession, root: str, staged: str, fmt: str = "parquet", threads: int = 16, written: DataFrame | None = None) -> int:
    """Make what is staged part of the archive, chain by chain, never over what is there; returns the number of segments.

    Staged segments get their names in tasks, a chain in each, in ascending order; a task that is run again knows its own
    links. A chain that already reaches what is to be committed refuses it; after the last name the chain is looked at
    again, so that of two writers who cut one log differently at the same time the one that sees the other's segments
    fails. A chain stops at its first failure, so what is visible is always a gap-free beginning; then the failure is
    raised. A run's folder (see records) gets a record per chain; written: its chains' destination, partition, first,
    last, segments, by default found by listing the folder.
    """
    if f"/{records.RUNS}/" in staged:
        if written is None:
            written = staged_segments(spark, staged).groupBy("destination", F.col("partition").cast("int").alias("partition")).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("segments"))
        return records.commit_run(spark, root, staged, written, fmt, threads)
    below = plain(staged)
    chains = [(d, p) for d in _folders(below, "_d=") for p in _folders(os.path.join(below, d), "_p=")]
    given = spark.createDataFrame(chains, "d string, p string").repartition(max(1, min(len(chains), spark.sparkContext.defaultParallelism)))
    sums = given.mapInPandas(_links(plain(root), below, fmt), "done bigint, kind string, message string").agg(F.sum("done").alias("done"), F.min(F.struct("kind", "message")).alias("failure")).first()
    given.mapInPandas(_cleared(below), "d string").agg(F.count("*")).collect()
    Files(spark, root).delete(staged)
    if (failure := sums["failure"]) is not None and failure["message"] is not None:
        raise {"exists": FileExistsError, "overlap": ValueError}.get(failure["kind"], OSError)(failure["message"])
    return sums["done"] or 0


def staged_segments(spark: SparkSession, staged: str) -> DataFrame:
    """destination, partition, first, last, path of the files of a staging folder."""
    part = lambda key: F.regexp_extract("path", f"/_{key}=([^/]*)/", 1)
    first, last = records.range_of(F.col("path"))
    return list_files(spark, staged).select(records._decoded(part("d")).alias("destination"), part("p").alias("partition"), first.alias("first"), last.alias("last"), "path").filter("first is not null")


def _links(base: str, below: str, fmt: str):
    """Gives what is staged of chains (d, p) its names: done, kind and message of the failure (or null) per chain.

    Tasks list what is staged of their chains. Staged files stay as second links of what they became.
    """
    ending = ENDINGS[fmt]

    def link(d: str, p: str) -> tuple[int, str | None, str | None]:
        chain, segments, done = (unquote(d[3:]), p[3:]), _staged_in(os.path.join(below, d, p)), 0
        if not segments:
            return 0, None, None
        folder = os.path.join(base, *chain)
        os.makedirs(folder, exist_ok=True)
        failure = reached(os.listdir(folder), chain, segments[0][0])
        if failure and not _only_own(folder, segments):  # all own: this chain's task was run before
            return 0, *failure
        for first, last, path in segments:
            target = os.path.join(folder, f"{first:020d}-{last:020d}.{ending}")
            try:
                os.link(path, target)
            except FileExistsError:
                if not os.path.samefile(path, target):
                    return done, "exists", f"{target} exists"
            except OSError as e:
                return done, "other", str(e)
            done += 1
        return done, *(overlap(os.listdir(folder), chain) or (None, None))

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, p in b.itertuples(index=False):
                yield pd.DataFrame([link(d, p)], columns=["done", "kind", "message"])

    return links


def _cleared(below: str):
    """Deletes what is staged of chains (d, p), once no task needs it any more."""

    def clear(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, p in b.itertuples(index=False):
                shutil.rmtree(os.path.join(below, d, p), ignore_errors=True)
            yield b[["d"]]

    return clear


def _folders(at: str, prefix: str) -> list[str]:
    return [x.name for x in os.scandir(at) if x.name.startswith(prefix)] if os.path.isdir(at) else []


def _staged_in(chain: str) -> list[tuple[int, int, str]]:
    """First and last offset and path of the segments in a chain's staging folder, in order."""
    return sorted((int(m[1]), int(m[2]), os.path.join(chain, name)) for name in os.listdir(chain) if (m := SEGMENT.fullmatch(name)))


def _only_own(folder: str, segments: list[tuple[int, int, str]]) -> bool:
    """Whether all segments in folder that end at the first staged one's begin or later are links of staged files."""
    own = {os.stat(path).st_ino for _, _, path in segments}
    late = [name for name in os.listdir(folder) if (m := SEGMENT.fullmatch(name)) and int(m[2]) >= segments[0][0]]
    return all(os.stat(os.path.join(folder, name)).st_ino in own for name in late)


def ranges(names: list[str]) -> list[tuple[int, int]]:
    """Offset ranges of the segment-shaped ones among names."""
    return [(int(m[1]), int(m[2])) for n in names if (m := SEGMENT.fullmatch(n))]


def reached(names: list[str], chain: tuple[str, str], first: int) -> tuple[str, str] | None:
    """What forbids to commit from first on: segments that end there or later."""
    reach = max((end for _, end in ranges(names)), default=-1)
    return ("exists", f"{'/'.join(chain)}: segments exist up to offset {reach}, the first to commit begins at {first}") if reach >= first else None


def overlap(names: list[str], chain: tuple[str, str]) -> tuple[str, str] | None:
    found = sorted(ranges(names))
    for (first, last), (begin, _) in zip(found, found[1:], strict=False):
        if begin <= last:
            return "overlap", f"{'/'.join(chain)}: segments overlap, {first}-{last} and one from {begin}; another writer is at work"
    return None


def clean_staging(spark: SparkSession, root: str, stale_ms: int = 86_400_000) -> int:
    """Delete staging folders, and runs that don't count, that nothing has changed for stale_ms, left by writers that died; returns how many."""
    files = Files(spark, root)
    if records.kept_by_records(spark, root):
        return records.clean_runs(spark, root, int(time.time() * 1000) - stale_ms)
    found = files.stale(f"{files.root}/{STAGING}", int(time.time() * 1000) - stale_ms)
    for folder in found:
        files.delete(folder)
    return len(found)


def archived(spark: SparkSession, root: str) -> DataFrame:
    """The catalogue of root's segments: topic (destination), partition, from_offset, to_offset, n_records, encoded_bytes,
    committed_at (when the file was written, or its record), ext, dir, name, length, modified, path."""
    if records.kept_by_records(spark, root):
        return records.committed_files(spark, root)
    files = list_files(spark, root).filter(~F.col("path").contains(f"/{STAGING}/"))
    found = catalogue(files).withColumn("topic", F.element_at(F.split("dir", "/"), -2)).withColumn("partition", F.element_at(F.split("dir", "/"), -1).try_cast("int"))
    rows = (F.col("to_offset") - F.col("from_offset") + 1).try_cast("bigint")
    return found.filter("partition is not null").withColumns({"n_records": rows, "encoded_bytes": F.col("length"), "committed_at": F.col("modified")})


def scan_parquet(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Envelopes of Parquet segments: columns by name, foreign offset types cast, unknown timestamp types replaced.

    paths: files or folders. With a schema no file is opened to find it, and all must be of it.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    return normalised((reader.schema(schema) if schema else reader).parquet(*([paths] if isinstance(paths, str) else paths)))


def scan_ndjson(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Envelopes of JSON-lines segments: blank lines and unknown fields are skipped, a malformed line fails the read."""
    return normalised(spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true").option("mode", "FAILFAST").json(paths))


def segment_files(spark: SparkSession, root: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the segment files below root, as stored, with the range of their file's name as _first and _last.

    No path is gathered: Spark lists root once, and filters on _first and _last choose files before any is opened.
    """
    if records.kept_by_records(spark, root):
        return records.committed_rows(spark, root, fmt, schema)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ENDINGS[fmt]}")
    if fmt == "ndjson":
        rows = reader.schema(ENVELOPE).option("mode", "FAILFAST").json(root)
    else:
        rows = (reader.schema(schema) if schema else reader).parquet(root)
    name = parsed_name(F.col("_metadata.file_name"))
    chain = F.element_at(F.split("_metadata.file_path", "/"), -2).try_cast("int")
    return rows.withColumns({"_first": name["first"], "_last": name["last"], "_chain": chain}).filter("_first is not null and _chain is not null").drop("_chain")


def replay(spark: SparkSession, root: str, fmt: str = "parquet", first: int | None = None, last: int | None = None, schema: T.StructType | None = ENVELOPE) -> DataFrame:
    """All rows of root's chains, or those with offsets first..last; segments outside are never opened. No root: no rows.

    Rows keep no order; sort by topic, partition and offset where order matters. Chains are not validated. schema: what
    Parquet segments hold; None takes it from one of them, for archives of foreign types.
    """
    if not Files(spark, root).exists(root):
        return spark.createDataFrame([], ENVELOPE)
    rows = segment_files(spark, root, fmt, schema)
    if first is not None:
        rows = rows.filter(F.col("_last") >= first)
    if last is not None:
        rows = rows.filter(F.col("_first") <= last)
    rows = normalised(rows)
    if first is None and last is None:
        return rows
    return rows.filter(F.col("offset").between(first if first is not None else 0, last if last is not None else 2**63 - 1))
