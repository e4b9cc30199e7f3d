"""The unbounded mirror: micro-batches only say how far the source has come."""

from __future__ import annotations

import threading
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import payload_bytes
from tidelog.operators import chains
from tidelog.plans.mirror import SourceGap, mirror_once, positions, starting
from tidelog.plans.storage import Files, stored
from tidelog.schema import ENVELOPE, LOG
from tidelog.streaming.progress import MirrorProgress


def mirror_stream(spark: SparkSession, source: str, root: str, checkpoint: str, read: Callable[[], DataFrame] | None = None, available_now: bool = True, interval: str = "2 seconds", files_per_batch: int | None = None, progress: MirrorProgress | None = None, **options):
    """Start mirroring the growing folder of envelope files at source into the archive at root.

    A batch's highest offsets bound what mirror_once reads, from the archive's own positions on, out of read() (default:
    the source's files). A lost or stale checkpoint thus neither loses nor repeats rows. Which offsets a source file
    holds is kept in an index beside the checkpoint, of the files not yet archived to their end (see FileRanges): a batch
    opens only files that meet an open tail or came with it. The index is no authority: if the rows it leads to have a
    gap, the whole source is read. progress: counts what each batch did.
    """
    stream = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    rows = stream.parquet(source).withColumn("_file", F.col("_metadata.file_path")).observe("mirror", F.count("*").alias("n_records"), F.sum(payload_bytes()).alias("payload_bytes"))
    index = None if read else FileRanges(spark, f"{checkpoint.rstrip('/')}-ranges")
    whole = read or (lambda: spark.read.schema(ENVELOPE).parquet(source))

    running = Running(spark, root, index, whole, options)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with running.lock:
            if not running.stopping:
                running.check_position()
                mirror_batch(batch, batch_id)

    def mirror_batch(batch: DataFrame, batch_id: int) -> None:
        ranges = stored(batch.groupBy(*LOG, "_file").agg(F.min("offset").alias("_first"), F.max("offset").alias("_last"), F.count("*").alias("n"), F.sum(payload_bytes()).cast("bigint").alias("size")), "ranges")  # the batch is read just once
        counts = ranges.groupBy(*LOG).agg(F.max("_last").alias("_upto"), F.sum("n").alias("n"), F.sum("size").alias("size")).collect()  # a row per log
        upto = spark.createDataFrame([(r["topic"], r["partition"], r["_upto"]) for r in counts], "topic string, partition int, _upto bigint")
        at = running.fresh
        starts = starting(at, options.get("mirrors"))
        bounds = seek_bounds(upto, starts)
        done: list[tuple] = []
        if index is None:
            mirror_once(spark, open_ranges(whole(), bounds), root, at=at, report=done, **options)
        else:
            index.add(batch_id, ranges, starts)
            try:
                mirror_once(spark, open_ranges(index.rows(bounds), bounds), root, at=at, report=done, **options)
            except SourceGap:
                mirror_once(spark, open_ranges(whole(), bounds), root, at=at, report=done, **options)
        running.remember(done)
        if progress is not None:
            made = {(t, p): (n, last + 1) for t, p, _, last, n in done}
            progress.seen(batch_id, [(r["topic"], r["partition"], r["n"], r["size"] or 0, *made.get((r["topic"], r["partition"]), (0, 0))) for r in counts])

    if progress is not None:
        spark.streams.addListener(progress)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if progress is not None:
        progress.run = str(query.runId)
    running.query, running.progress, query.mirror = query, progress, running
    return query


class DestinationDrift(ValueError):
    """The archive isn't where this mirror left it: somebody else has written to it."""


class Running:
    """What a mirror's batches, its heartbeat and its stop share: one of them at a time looks at the archive."""

    def __init__(self, spark: SparkSession, root: str, index: FileRanges | None, whole: Callable[[], DataFrame], options: dict):
        self.spark, self.root, self.index, self.whole, self.options = spark, root, index, whole, options
        self.lock, self.stopping, self.remembered, self.fresh = threading.Lock(), False, None, None
        self.query = self.progress = None

    def known(self) -> DataFrame:
        """topic (destination), partition, next_offset as this mirror left them."""
        return self.spark.createDataFrame([(*log, n) for log, n in (self.remembered or {}).items()], "topic string, partition int, next_offset bigint")

    def check_position(self) -> None:
        """Look the archive's position up; after the first time it must be the remembered one."""
        self.fresh = positions(self.spark, self.root, self.options.get("fmt", "parquet"))
        if self.remembered is None:
            self.remembered = {(r["topic"], r["partition"]): r["next_offset"] for r in self.fresh.collect()}  # a row per chain
        else:
            chains.require_none(chains.idle_drift(self.known(), self.fresh), "destination drift", DestinationDrift)

    def remember(self, done: list[tuple]) -> None:
        self.remembered.update({(destination, p): last + 1 for _, p, destination, last, _ in done})


def stop_mirror(query, drain: bool = True) -> int:
    """Stop a mirror once its batch is done and, with drain, archive what it has seen of open segments; returns the segments.

    A batch that begins meanwhile does nothing. Rows are archived once, since the archive's position says from where.
    """
    running = query.mirror
    running.stopping = True
    with running.lock:
        query.stop()
        if not drain:
            return 0
        running.check_position()
        starts = starting(running.fresh, running.options.get("mirrors"))
        seen = running.index.latest() if running.index else running.whole().select(*LOG, F.col("offset").alias("_last"))
        if seen is None:
            return 0
        bounds = stored(seek_bounds(seen.groupBy(*LOG).agg(F.max("_last").alias("_upto")), starts), "bounds")
        run = lambda rows: mirror_once(running.spark, open_ranges(rows, bounds), running.root, at=running.fresh, **running.options | {"drain": True})
        if not running.index:
            return run(running.whole())
        try:
            return run(running.index.rows(bounds))
        except SourceGap:
            return run(running.whole())


def heartbeat(query, interval: str, beats: str):
    """Start the heartbeat of a running mirror: every interval, with input or without, a row per log is appended to the table at beats.

    Rows: beat (number), at, topic, partition, expected (the archive's next offset), n_records (seen since the last beat,
    where the mirror has a MirrorProgress). If no batch is at work, the archive's position is looked up and compared with
    the remembered one; if it has moved, the mirror is stopped and the heartbeat fails with DestinationDrift.
    """
    running, spark, counted = query.mirror, query.mirror.spark, {}

    def beat(batch: DataFrame, number: int) -> None:
        if running.lock.acquire(blocking=False):
            try:
                if running.remembered is not None and not running.stopping:
                    running.check_position()
            except DestinationDrift:
                query.stop()
                raise
            finally:
                running.lock.release()
        totals = dict(running.progress.logs) if running.progress else {}
        rows = [(number, *log, n, totals[log][0] - counted.get(log, 0) if log in totals else None) for log, n in (running.remembered or {}).items()]
        counted.update({log: t[0] for log, t in totals.items()})
        spark.createDataFrame(rows, "beat bigint, topic string, partition int, expected bigint, n_records bigint").withColumn("at", F.now()).write.mode("append").parquet(beats)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(beat).trigger(processingTime=interval).option("checkpointLocation", f"{beats.rstrip('/')}-clock").start()


class FileRanges:
    """Which offsets of which logs the source's files hold, as far as they aren't archived: a generation per batch.

    A generation is the one before without files that end before their log's position, and the batch's own files; it is
    written anew under the batch's number, so a batch that is tried again leaves the same.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files, self.opened = spark, folder, Files(spark, folder), []

    def _generations(self) -> list[int]:
        return sorted(int(n) for n in self.files.names(self.folder) if n.isdigit()) if self.files.exists(self.folder) else []

    def add(self, batch_id: int, ranges: DataFrame, starts: DataFrame) -> None:
        own, earlier = ranges.select(*LOG, "_file", "_first", "_last"), [g for g in self._generations() if g < batch_id]
        if earlier:
            known = self.spark.read.schema(own.schema).parquet(f"{self.folder}/{earlier[-1]}")
            own = own.unionByName(known.join(starts, LOG, "left").filter("_last >= coalesce(next_offset, 0)").select(own.columns))
        own.write.mode("overwrite").parquet(f"{self.folder}/{batch_id}")
        for old in earlier[:-1]:
            self.files.delete(f"{self.folder}/{old}")
        self.known = self.spark.read.schema(own.schema).parquet(f"{self.folder}/{batch_id}")

    def latest(self) -> DataFrame | None:
        """The last generation, or None."""
        if not (found := self._generations()):
            return None
        self.known = self.spark.read.schema("topic string, partition int, _file string, _first bigint, _last bigint").parquet(f"{self.folder}/{found[-1]}")
        return self.known

    def rows(self, bounds: DataFrame) -> DataFrame:
        """The rows of the files that meet the bounds (topic, partition, _from, _upto)."""
        met = self.known.join(bounds, LOG).filter("_first <= _upto and _last >= _from").select("_file").distinct()
        self.opened = [r["_file"] for r in met.collect()]  # open tails' and the batch's files
        return self.spark.read.schema(ENVELOPE).parquet(*[unquote(f) for f in self.opened]) if self.opened else self.spark.createDataFrame([], ENVELOPE)


def seek_bounds(upto: DataFrame, starts: DataFrame) -> DataFrame:
    """topic, partition, _from, _upto of the logs in upto that have something to read."""
    return upto.join(starts, LOG, "left").select(*LOG, F.coalesce("next_offset", F.lit(0)).alias("_from"), "_upto").filter("_from <= _upto")


def open_ranges(log: DataFrame, bounds: DataFrame, most: int = 128) -> DataFrame:
    """log's rows within the bounds (topic, partition, _from, _upto).

    The join decides; the filter before it only lets the scan skip. Up to `most` logs have a condition each, more share
    one by partition number.
    """
    wanted = [tuple(r) for r in bounds.collect()]  # a row per log
    if len(wanted) > most:
        wanted = [(None, p, min(w[2] for w in wanted if w[1] == p), max(w[3] for w in wanted if w[1] == p)) for p in {w[1] for w in wanted}]
    if len(wanted) > most:
        wanted = [(None, None, min(w[2] for w in wanted), max(w[3] for w in wanted))]
    pick = F.lit(False)
    for topic, partition, first, last in wanted:
        this = F.col("offset").between(first, last)
        if partition is not None:
            this &= F.col("partition") == partition
        if topic is not None:
            this &= F.col("topic") == topic
        pick |= this
    return log.filter(pick).join(bounds, LOG).filter("offset between _from and _upto").drop("_from", "_upto")
