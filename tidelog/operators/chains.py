"""Chains of segments: catalogue, validation, conflicts, gates."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.columns import parsed_name
from tidelog.plans.storage import Files, plain
from tidelog.schema import ENDINGS, LOG

#: Tasks that folders are dealt to when they are listed, at most.
MOST_LISTERS = 1000


def catalogue(files: DataFrame) -> DataFrame:
    """dir, name, from_offset, to_offset, ext of the files (dir, name, other columns stay) whose names are segment-shaped.

    Temporary and foreign names are left out. Offsets are decimals, as names may exceed a long.
    """
    found = files.withColumn("_s", parsed_name(F.col("name"))).filter("_s is not null")
    return found.withColumn("from_offset", F.col("_s.first")).withColumn("to_offset", F.col("_s.last")).withColumn("ext", F.col("_s.ending")).drop("_s")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """dir, name, length, modified, path of all files below root; no rows if root doesn't exist. Hidden names (those that
    Spark's readers skip) are left out, with what is below them.

    Folders of the file system are listed in tasks, one for each folder two levels down (a chain), so no list of all
    files is held anywhere.
    """
    files = Files(spark, root)
    if not files.exists(root):
        return spark.createDataFrame([], "dir string, name string, length bigint, modified timestamp, path string")
    if files.local:
        seeds = [(plain(root).rstrip("/") or "/", False)]
        seeds += [(x, False) for x in _folders(seeds[0][0])]
        seeds += [(y, True) for x, _ in seeds[1:] for y in _folders(x)]
        found = spark.createDataFrame(seeds, "folder string, deep boolean").repartition(min(len(seeds), MOST_LISTERS)).mapInArrow(_listed, "path string, length bigint, modified bigint")
        found = found.withColumn("modified", F.timestamp_millis("modified"))
    else:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    return found.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modified", "path")


def _visible(name: str) -> bool:
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _folders(at: str) -> list[str]:
    return [x.path for x in os.scandir(at) if _visible(x.name) and x.is_dir()]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files in each folder, where asked those further below too. What is deleted meanwhile is no longer there."""
    for b in batches:
        for seed, deep in zip(b["folder"].to_pylist(), b["deep"].to_pylist(), strict=True):
            folders = [seed]
            while folders:
                found = []
                with contextlib.suppress(FileNotFoundError), os.scandir(folders.pop()) as entries:
                    for x in entries:
                        with contextlib.suppress(FileNotFoundError):
                            if not _visible(x.name):
                                continue
                            if not x.is_dir():
                                at = x.stat()
                                found.append((f"file:{x.path}", at.st_size, at.st_mtime_ns // 1_000_000))
                            elif deep:
                                folders.append(x.path)
                for i in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found[i : i + 10_000], strict=True)], names=["path", "length", "modified"])


def violations(segments: DataFrame, fmt: str = "parquet", by: tuple[str, ...] = ("dir",)) -> DataFrame:
    """What is wrong with chains: by, kind, from_offset, to_offset, expected_from.

    mixed_format: a segment of another format; inverted_range: its end lies before its begin; gap_or_overlap: sorted by
    begin and end, a segment doesn't begin right after the one before, or the first not at 0.
    """
    w = Window.partitionBy(*by).orderBy("from_offset", "to_offset")
    none = F.lit(None).cast("decimal(38,0)")
    wide = segments.withColumn("from_offset", F.col("from_offset").cast("decimal(38,0)")).withColumn("to_offset", F.col("to_offset").cast("decimal(38,0)"))
    show = lambda df, kind, expected: df.select(*by, F.lit(kind).alias("kind"), "from_offset", "to_offset", expected.cast("decimal(38,0)").alias("expected_from"))
    mixed = show(wide.filter(F.col("ext") != ENDINGS[fmt]), "mixed_format", none)
    own = wide.filter(F.col("ext") == ENDINGS[fmt])
    inverted = show(own.filter("to_offset < from_offset"), "inverted_range", none)
    chained = own.filter("to_offset >= from_offset").withColumn("_want", F.coalesce(F.lag("to_offset").over(w) + 1, F.lit(0)))
    return mixed.unionByName(inverted).unionByName(show(chained.filter("from_offset != _want"), "gap_or_overlap", F.col("_want")))


def require_none(found: DataFrame, what: str, kind: type[Exception] = ValueError) -> None:
    """Raise with a first example if there is any row."""
    if example := found.first():
        raise kind(f"{what}: {example.asDict()}")


def conflicts(proposed: DataFrame, existing: DataFrame, by: tuple[str, ...] = ("topic", "partition")) -> DataFrame:
    """Proposed segments that overlap an existing one of the same log.

    Both sides are put in one order per log; of the existing segments that begin no later than a proposed one ends, the
    largest end decides, so no pair is ever formed.
    """
    ends = existing.select(*by, F.col("from_offset").alias("_at"), F.col("to_offset").alias("_reach"), F.lit(0).alias("_own"))
    asks = proposed.withColumn("_at", F.col("to_offset")).withColumn("_own", F.lit(1))
    w = Window.partitionBy(*by).orderBy("_at", "_own").rowsBetween(Window.unboundedPreceding, 0)
    both = asks.unionByName(ends, allowMissingColumns=True).withColumn("_far", F.max("_reach").over(w))
    return both.filter("_own = 1 and _far >= from_offset").select(*proposed.columns)


def same_key(proposed: DataFrame, existing: DataFrame, by: tuple[str, ...] = ("topic", "partition")) -> DataFrame:
    """Proposed segments whose range is already there."""
    return proposed.join(existing.select(*by, "from_offset", "to_offset"), [*by, "from_offset", "to_offset"], "left_semi").select(*proposed.columns)


def gate_contiguous(rows: DataFrame, positions: DataFrame | None = None, arrival: str | None = None, bits: int = 20) -> DataFrame:
    """Rows whose offset isn't the expected one: topic, partition, expected, actual.

    The first of a log is expected at its position (default 0), any other one after the row before, by arrival (a number
    or time; ties by offset) or else by offset. A log is looked at in stretches of 2^bits steps of that order, each of
    which only needs the last offset of the stretch before, so one big log is many tasks.
    """
    here, order = [*LOG, "_stretch"], F.col(arrival or "offset")
    rows = rows.select(*LOG, "offset", order.alias("_at"), F.shiftright(order.cast("bigint"), bits).alias("_stretch"))
    before = F.lag("_last").over(Window.partitionBy(*LOG).orderBy("_stretch"))
    last = rows.groupBy(*here).agg(F.max(F.struct("_at", "offset"))["offset"].alias("_last")).withColumn("_before", before)
    if positions is not None:
        last = last.join(positions.select(*LOG, "next_offset"), LOG, "left")
    else:
        last = last.withColumn("next_offset", F.lit(0))
    last = last.select(*here, F.coalesce(F.col("_before") + 1, "next_offset", F.lit(0)).cast("bigint").alias("_opens"))
    within = F.lag("offset").over(Window.partitionBy(*here).orderBy("_at", "offset")) + 1
    found = rows.withColumn("_within", within).join(last, here)
    return found.withColumn("expected", F.coalesce("_within", "_opens")).filter("offset != expected").select(*LOG, "expected", F.col("offset").alias("actual"))


def gate_position(batch: DataFrame, positions: DataFrame) -> DataFrame:
    """Logs whose batch doesn't begin at the destination's next offset: topic, partition, expected, actual."""
    first = batch.groupBy(*LOG).agg(F.min("offset").alias("actual"))
    return first.join(positions.select(*LOG, "next_offset"), LOG, "left").select(*LOG, F.coalesce("next_offset", F.lit(0)).cast("bigint").alias("expected"), "actual").filter("expected != actual")


def gate_produced(sent: DataFrame, destination: DataFrame) -> DataFrame:
    """Sent rows that the destination doesn't hold at their own offset."""
    return sent.select(*LOG, "offset").join(destination.select(*LOG, "offset"), [*LOG, "offset"], "left_anti")


def idle_drift(remembered: DataFrame, fresh: DataFrame) -> DataFrame:
    """Logs whose destination has moved: topic, partition, expected (remembered), actual (fresh)."""
    a, b = remembered.select(*LOG, F.col("next_offset").alias("expected")), fresh.select(*LOG, F.col("next_offset").alias("actual"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return a.join(b, LOG, "full").select(*LOG, zero("expected"), zero("actual")).filter("expected != actual")
