"""Mirroring a log into an archive or another log; positions come from the destination alone."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import chains, segments
from tidelog.plans import records
from tidelog.plans.archive import archived, clean_staging, commit_segments, stage_segments
from tidelog.plans.storage import Files, shared_dir, stored
from tidelog.schema import ENVELOPE, LOG
from tidelog.sources.log import assigned, high_watermark, seek


class SourceGap(ValueError):
    """The source's rows don't follow on from the archive, or on each other."""


def positions(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """topic (destination), partition, next_offset of a valid archive; a broken chain raises."""
    found = verified(spark, root, fmt)
    chains.require_none(found.filter("error is not null"), "corrupt chain")
    return found.drop("error")


def verified(spark: SparkSession, root: str, fmt: str = "parquet", whole: bool = False) -> DataFrame:
    """topic (destination), partition, next_offset, error (the first violation, which leaves next_offset null) per chain.

    The archive is listed once; the result, a row a chain, is kept in the checkpoint folder. Of an archive with commit
    records only these are read, a range a run, unless whole asks for its segments too.
    """
    shared_dir(spark)
    by_record = records.kept_by_records(spark, root) and not whole
    found = records.record_positions(spark, root) if by_record else archived(spark, root).select("topic", "partition", "from_offset", "to_offset", "ext")
    found = found.checkpoint()
    wrong = chains.violations(found, fmt, LOG).groupBy(*LOG).agg(F.min(F.struct("from_offset", "to_offset", "kind")).alias("_w"))
    text = F.concat("_w.kind", F.lit(" at "), F.col("_w.from_offset").cast("string"), F.lit("-"), F.col("_w.to_offset").cast("string"))
    known = segments.next_expected(found).join(wrong, LOG, "left")
    return known.select(*LOG, F.when(F.col("_w").isNull(), F.col("next_offset")).alias("next_offset"), text.alias("error")).checkpoint()


def starting(at: DataFrame, mirrors: DataFrame | None = None) -> DataFrame:
    """topic, partition, next_offset of the source logs, from destinations' positions."""
    if mirrors is None:
        return at
    names = mirrors.select(*LOG, F.coalesce("destination_name_override", "topic").alias("destination"))
    return names.join(at.withColumnRenamed("topic", "destination"), ["destination", "partition"]).select(*LOG, "next_offset")


def mirror_once(spark: SparkSession, log: DataFrame, root: str, mirrors: DataFrame | None = None, fmt: str = "parquet", codec: str = "zstd", drain: bool = False, on_gap: str = "fail", mode: str = "directory", at: DataFrame | None = None, by_record: bool | None = None, report: list | None = None, **limits: int) -> int:
    """Bring the archive at root up to log: position, seek, gate, cut, write, commit; returns the segments committed.

    All logs of one call are mirrored by the same jobs, in parallel. mirrors (see assigned) choose logs and name their
    destinations; by default every log goes to its topic. Rows of an open segment stay unwritten unless drain, and are
    read again next time; what a writer that died has left in the staging folder is cleared after a day. on_gap: `fail` writes nothing if any log has a gap, `commit_prefix` writes what comes before.
    at: the archive's positions where the caller has them already. by_record: segments count by commit records (see
    records), by default where the archive has them or its file system gives no names afterwards. report: gets, per log
    with new segments, topic, partition, destination, last offset and segments.
    """
    rows = log.withColumn("destination", F.col("topic")) if mirrors is None else assigned(log, mirrors).drop("mirror")
    clean_staging(spark, root)
    starts = starting(positions(spark, root, fmt) if at is None else at, mirrors)
    rows = seek(rows, starts)
    found = chains.gate_contiguous(rows, starts)
    if on_gap == "commit_prefix":
        gaps = found.groupBy(*LOG).agg(F.min("actual").alias("_gap"))
        rows = rows.join(gaps, LOG, "left").filter("_gap is null or offset < _gap").drop("_gap")
    else:
        chains.require_none(found, "source offset mismatch", SourceGap)
    if set(limits) <= {"max_offsets"}:  # arithmetic, from each log's own position
        step = max(1, limits.get("max_offsets", segments.ENDLESS))
        cut = segments.by_count(rows, step, starts)
        bounds = cut.groupBy(*LOG, "from_offset").agg(F.max("offset").alias("to_offset"), F.count("*").alias("n_records")).withColumn("closed", F.col("n_records") >= step)
        bounds = stored(segments.drained(bounds, drain), "segments")
        rows = cut.join(bounds.select(*LOG, "from_offset", "to_offset"), [*LOG, "from_offset"])
    else:
        bounds = stored(segments.drained(segments.cut(rows, mode=mode, **limits), drain), "segments")
        rows = segments.with_segments(rows, bounds)
    if by_record is None:
        by_record = records.kept_by_records(spark, root)
    staged = stage_segments(rows, root, fmt, codec, by_record)
    named = bounds.withColumn("destination", F.col("topic")) if mirrors is None else assigned(bounds, mirrors)
    written = named.groupBy("destination", "partition").agg(F.min("from_offset").alias("first"), F.max("to_offset").alias("last"), F.count("*").alias("segments"))
    done = commit_segments(spark, root, staged, fmt, written=written)
    if report is not None:
        report += [tuple(r) for r in named.groupBy(*LOG, "destination").agg(F.max("to_offset"), F.count("*")).collect()]
    return done


def append_log(delta: DataFrame, destination: DataFrame, timestamps: str = "source", ingest_ms: int | None = None, at: DataFrame | None = None) -> DataFrame:
    """What appending delta to the log table destination adds: its rows from the destination's high watermark on.

    Offsets are kept, and the first must be the watermark and the rest follow without a gap, else it raises.
    timestamps: `source` keeps timestamp_ms, `destination` stamps ingest_ms; a row without a time is stamped in either
    case. Kept and stamped times are stored as create_time and log_append_time. at: the table's high watermarks where they
    are known (as next_offset).
    """
    at = high_watermark(destination).withColumnRenamed("high", "next_offset") if at is None else at
    rows = delta.join(at, LOG, "left").filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")
    chains.require_none(chains.gate_contiguous(rows, at), "unexpected position")
    own = F.lit(timestamps == "source") & F.col("timestamp_ms").isNotNull()
    return rows.withColumn("timestamp_type", F.when(own, "create_time").otherwise("log_append_time")).withColumn("timestamp_ms", F.when(own, F.col("timestamp_ms")).otherwise(F.lit(ingest_ms)).cast("bigint"))


VERSIONS = "_versions"


def log_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The log table at path, or what it was at a version: the files it began with, and the runs that its versions name.

    No table yet: no rows.
    """
    files = Files(spark, path)
    if not files.exists(path):
        return spark.createDataFrame([], ENVELOPE)
    own = spark.read.schema(ENVELOPE).parquet(path)
    if not (last := latest_version(files) if version is None else version):
        return own
    named = spark.read.schema("run string").json(f"{files.root}/{VERSIONS}").filter(F.substring_index(F.col("_metadata.file_name"), ".", 1).cast("bigint") <= last)
    runs = spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField("_r", T.StringType())])).parquet(f"{files.root}/{records.RUNS}")
    return own.unionByName(runs.join(named.select(F.col("run").alias("_r")), "_r", "left_semi").select(*ENVELOPE.fieldNames()))


def latest_version(files: Files) -> int:
    """The number of the table's last version, 0 where it has none."""
    at = f"{files.root}/{VERSIONS}"
    return max((int(n.split(".")[0]) for n in files.names(at)), default=0) if files.exists(at) else 0


def append_once(spark: SparkSession, log: DataFrame, path: str, timestamps: str = "source", ingest_ms: int | None = None) -> int:
    """Append to the log table at path what it lacks of log; returns the rows added.

    The position is the table's own high watermark, so a call again adds nothing. What is written is looked at, every row
    at its own offset, before it is part of the table: that takes the file of the table's next version, which only one
    writer can create. Of two writers at once the other raises, and none of its rows is ever seen (see log_table).
    """
    files = Files(spark, path)
    version = latest_version(files)
    shared_dir(spark)
    before = log_table(spark, path, version)
    high = high_watermark(before).withColumnRenamed("high", "next_offset").checkpoint()
    run = uuid.uuid4().hex
    folder = records.run_folder(path, run)
    append_log(log, before, timestamps, ingest_ms, at=high).write.parquet(folder)
    added = spark.read.schema(ENVELOPE).parquet(folder)
    chains.require_none(chains.gate_contiguous(added, high), "produced offsets")
    chains.require_none(chains.gate_produced(seek(log, high), added), "produced offsets")
    if not (n := added.count()):
        files.delete(folder)
        return 0
    name = f"{files.root}/{VERSIONS}/{version + 1:020d}.json"
    try:
        files.create(name, json.dumps({"run": run}))
    except FileExistsError:
        files.delete(folder)
        raise
    return n
