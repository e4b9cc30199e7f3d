"""Archives whose segments count by commit records, for stores where a name can't be given afterwards (object stores).

Tasks write segments straight to their place, root/_runs/_r=<run>/_d=<destination>/_p=<partition>/_s=<from>-<to>/, or, on
folders of the file system, to <from>-<to>.<ending> below the partition's folder. A run counts, for a chain, by one small record root/_commits/<destination>/<partition>/<first>.json, which can be created only
once; so of two writers at the same position one commits, and the other's files are never seen. A commit takes three
calls per chain, whatever the number of segments, and the driver holds a row per chain. Positions are read from the
records alone.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import chains
from tidelog.plans.storage import Files
from tidelog.schema import ENDINGS, ENVELOPE, LOG

RUNS, COMMITS = "_runs", "_commits"
RECORD = "destination string, partition int, run string, first bigint, last bigint, segments bigint, format string"
PLACE = T.StructType([T.StructField(c, T.StringType()) for c in ("_r", "_d", "_p", "_s")])


def kept_by_records(spark: SparkSession, root: str) -> bool:
    files = Files(spark, root)
    return not files.local or files.exists(f"{files.root}/{COMMITS}")


def run_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/{RUNS}/_r={run}"


def commit_run(spark: SparkSession, root: str, folder: str, written: DataFrame, fmt: str = "parquet", threads: int = 16) -> int:
    """Make the run in folder count: a record per chain of written (destination, partition, first, last, segments); returns the segments.

    A chain whose records don't end right before first refuses the run, and so does one where another writer's record of
    the same first is there. Other chains are committed all the same; then the failure is raised.
    """
    files, run = Files(spark, root), folder.rstrip("/").rsplit("_r=", 1)[1]
    rows = written.select("destination", "partition", "first", "last", "segments").collect()  # a row per chain

    def commit(row) -> tuple[int, Exception | None]:
        try:
            at = _folder(files, row["destination"], row["partition"])
            following = next_of(files, at)
            record = json.dumps(row.asDict() | {"run": run, "format": fmt})
            name = f"{at}/{row['first']:020d}.json"
            if row["first"] != following and not (files.exists(name) and files.text(name) == record):
                raise FileExistsError(f"{row['destination']}/{row['partition']}: committed up to offset {following - 1}, the first to commit is {row['first']}")
            files.create(name, record)
        except Exception as e:
            return 0, e
        return row["segments"], None

    with ThreadPoolExecutor(threads) as pool:
        done = list(pool.map(commit, rows))
    for _, failure in done:
        if failure is not None:
            raise failure
    return sum(n for n, _ in done)


def _folder(files: Files, destination: str, partition: int) -> str:
    return f"{files.root}/{COMMITS}/{quote(destination, safe='')}/{partition}"


def next_of(files: Files, folder: str) -> int:
    """The offset after the last record in folder; a record that its writer left empty doesn't count."""
    if files.exists(folder):
        for name in sorted((n for n in files.names(folder) if n.endswith(".json")), reverse=True):
            if text := files.text(f"{folder}/{name}"):
                return json.loads(text)["last"] + 1
    return 0


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The records: topic (destination), partition, run, first, last, segments, format, committed_at."""
    files = Files(spark, root)
    if not files.exists(f"{files.root}/{COMMITS}"):
        return spark.createDataFrame([], f"topic string, partition int, run string, first bigint, last bigint, segments bigint, format string, committed_at timestamp")
    found = spark.read.schema(RECORD).option("recursiveFileLookup", "true").json(f"{files.root}/{COMMITS}").filter("run is not null")
    return found.select(F.col("destination").alias("topic"), "partition", "run", "first", "last", "segments", "format", F.col("_metadata.file_modification_time").alias("committed_at"))


def record_positions(spark: SparkSession, root: str) -> DataFrame:
    """topic, partition, from_offset, to_offset, ext of what each record commits: chains of records are validated as chains of segments are."""
    ending = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])
    return commits(spark, root).select(*LOG, F.col("first").alias("from_offset"), F.col("last").alias("to_offset"), ending[F.col("format")].alias("ext"))


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """The catalogue of what counts: topic, partition, from_offset, to_offset, n_records, encoded_bytes, committed_at, ext, dir, name, length, modified, path.

    committed_at is the time of the record. Files of runs that don't count are left out.
    """
    runs = f"{root.rstrip('/')}/{RUNS}"
    files = chains.list_files(spark, runs)
    part = lambda key: F.regexp_extract("path", f"/_{key}=([^/]*)/", 1)
    found = files.select("path", "length", "modified", "dir", part("r").alias("run"), _decoded(part("d")).alias("topic"), part("p").try_cast("int").alias("partition"), *range_of(F.col("path")))
    counted = commits(spark, root).select(*LOG, "run", "first", "last", "format", "committed_at")
    found = found.join(counted, [*LOG, "run"]).filter("from_offset >= first and to_offset <= last")
    return found.select(*LOG, "from_offset", "to_offset", (F.col("to_offset") - F.col("from_offset") + 1).alias("n_records"), F.col("length").alias("encoded_bytes"), "committed_at", F.col("format").alias("ext"), "dir", F.format_string("%020d-%020d.%s", "from_offset", "to_offset", "format").alias("name"), "length", "modified", "path")


def range_of(path: Column) -> list[Column]:
    """from_offset, to_offset of a run's file, by its own name or the folder that Spark's writer made for it; else null."""
    at = lambda i: F.regexp_extract(path, r"(?:/_s=|/_p=[^/]*/)([0-9]+)-([0-9]+)[./]", i).try_cast("bigint")
    return [at(1).alias("from_offset"), at(2).alias("to_offset")]


def _decoded(s: Column) -> Column:
    """The value of a folder's name as Spark writes it; a plus sign stands for itself there."""
    return F.url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))


def committed_rows(spark: SparkSession, root: str, fmt: str, schema: T.StructType | None) -> DataFrame:
    """The rows of the runs that count, as stored, with _first and _last of their segment.

    Segments are chosen by the folders' values before any file is opened, also by the records, which are joined.
    """
    runs, files = f"{root.rstrip('/')}/{RUNS}", Files(spark, root)
    whole = schema or ENVELOPE
    if not files.exists(runs):
        return spark.createDataFrame([], ENVELOPE).withColumns({"_first": F.lit(None).cast("bigint"), "_last": F.lit(None).cast("bigint")})
    reader = spark.read.schema(whole).option("recursiveFileLookup", "true") if files.local else spark.read.schema(T.StructType([*whole.fields, *PLACE.fields]))
    rows = reader.option("mode", "FAILFAST").json(runs) if fmt == "ndjson" else reader.parquet(runs)
    if files.local:  # of either layout, so places are read from paths
        path = _decoded(F.col("_metadata.file_path"))
        part = lambda key: F.regexp_extract(path, f"/_{key}=([^/]*)/", 1)
        first, last = range_of(path)
        rows = rows.withColumns({"_r": part("r"), "_d": _decoded(part("d")), "_p": part("p"), "_first": first, "_last": last})
        known = [r["run"] for r in commits(spark, root).select("run").distinct().limit(1001).collect()]
        if len(known) <= 1000:  # leaves the files of other runs unopened; beyond, the join alone decides
            rows = rows.filter(F.col("_r").isin(known))
    else:
        first, last = range_of(F.concat(F.lit("/_s="), "_s", F.lit("/")))
        rows = rows.withColumns({"_first": first, "_last": last})
    counted = commits(spark, root).filter(F.col("format") == fmt).select(F.col("run").alias("_r"), F.col("topic").alias("_d"), F.col("partition").cast("string").alias("_p")).distinct()
    return rows.join(counted, ["_r", "_d", "_p"], "left_semi").drop(*PLACE.fieldNames())


def clean_runs(spark: SparkSession, root: str, before_ms: int) -> int:
    """Delete runs that no record names and nothing has changed since before_ms, and records left empty since then; returns how many."""
    files = Files(spark, root)
    counted = {r["run"] for r in commits(spark, root).select("run").distinct().toLocalIterator()}  # a row per run
    old = [p for p in files.stale(f"{files.root}/{RUNS}", before_ms) if p.rsplit("_r=", 1)[-1] not in counted]
    empty = [r["path"] for r in chains.list_files(spark, f"{files.root}/{COMMITS}").filter((F.col("length") == 0) & (F.unix_millis("modified") < before_ms)).select("path").toLocalIterator()]
    for path in [*old, *empty]:
        files.delete(path)
    return len(old) + len(empty)
