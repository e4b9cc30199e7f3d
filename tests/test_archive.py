import glob
import os
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidelog.operators import chains, reports, segments
from tidelog.plans import archive, mirror, storage
from tidelog.plans import records as commit_records
from tidelog.plans.storage import Files, plain
from tidelog.schema import ENVELOPE
from tidelog.sources import archive_source
from tidelog.sources import log as logs
from tidelog.streaming import mirror as streaming_mirror
from tidelog.streaming.mirror import MirrorProgress, heartbeat, mirror_stream, stop_mirror


def records(spark, n, topic="t", partition=0, first=0):
    rows = [(topic, partition, i, None if i == 7 else 1_700_000_000_000 + i, ("create_time", "log_append_time", "not_available")[i % 3], None if i == 5 else f"k{i:04}".encode(), None if i == 9 else (b"" if i == 11 else f"v{i:04}".encode()), [] if i % 4 == 0 else [("trace-id", f"t{i}".encode()), ("trace-id", None)]) for i in range(first, first + n)]
    return spark.createDataFrame(rows, ENVELOPE)


@pytest.fixture
def root(spark):
    return f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"


def names(spark, root):
    return [r["name"] for r in archive.archived(spark, root).orderBy("topic", "partition", "name").collect()]


def same(a, b):
    key = lambda r: (r["topic"], r["partition"], r["offset"])
    return sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


@pytest.mark.parametrize("codec", ["zstd", "snappy", "lz4", "uncompressed"])
def test_round_trip(spark, root, codec):
    log = records(spark, 30)
    mirror.mirror_once(spark, log, root, codec=codec, drain=True, max_offsets=10)
    assert same(archive.replay(spark, root), log)


def test_ndjson_round_trip(spark, root):
    log = records(spark, 30)
    mirror.mirror_once(spark, log, root, fmt="ndjson", drain=True, max_offsets=10)
    assert same(archive.replay(spark, root, "ndjson"), log)


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "x.ndjson"
    path.write_text('{"topic":"t","partition":0,"offset":0,"timestamp_type":"odd","more":1}\n\n')
    row = archive.scan_ndjson(spark, [str(path)]).first()
    assert (row["timestamp_type"], row["headers"], row["key"]) == ("not_available", [], None)
    path.write_text("{oops\n")
    with pytest.raises(Exception):  # noqa: B017
        archive.scan_ndjson(spark, [str(path)]).collect()


def test_restart_names(spark, root):
    log = records(spark, 35)
    assert mirror.mirror_once(spark, log.filter("offset < 25"), root, max_offsets=10) == 2
    assert mirror.mirror_once(spark, log, root, drain=True, max_offsets=10) == 2
    assert names(spark, root) == [f"{a:020d}-{b:020d}.parquet" for a, b in ((0, 9), (10, 19), (20, 29), (30, 34))]
    assert mirror.mirror_once(spark, log, root, drain=True, max_offsets=10) == 0


def test_gap_fails_or_commits_prefix(spark, root):
    log = records(spark, 30).filter("offset != 17")
    with pytest.raises(ValueError, match="mismatch"):
        mirror.mirror_once(spark, log, root, drain=True, max_offsets=10)
    assert names(spark, root) == []
    assert mirror.mirror_once(spark, log, root, drain=True, on_gap="commit_prefix", max_offsets=10) == 2
    assert names(spark, root)[-1] == f"{10:020d}-{16:020d}.parquet"


def test_commit_never_overwrites(spark, root):
    rows = records(spark, 10).withColumn("destination", F.col("topic")).withColumn("from_offset", F.lit(0)).withColumn("to_offset", F.lit(9))
    assert archive.commit_segments(spark, root, archive.stage_segments(rows, root)) == 1
    with pytest.raises(Exception, match="[Ee]xist"):
        archive.commit_segments(spark, root, archive.stage_segments(rows, root))


def test_of_two_writers_the_second_fails(spark, root):
    def staged(count):
        rows = segments.by_count(records(spark, 40).withColumn("destination", F.col("topic")), count)
        ends = rows.groupBy("from_offset").agg(F.max("offset").alias("to_offset"))
        return archive.stage_segments(rows.join(ends, "from_offset"), root)

    ten, seven = staged(10), staged(7)
    assert archive.commit_segments(spark, root, ten) == 4
    with pytest.raises(FileExistsError, match="reach|exist"):
        archive.commit_segments(spark, root, seven)
    assert names(spark, root) == [f"{a:020d}-{a + 9:020d}.parquet" for a in (0, 10, 20, 30)]
    assert chains.violations(archive.archived(spark, root), "parquet", ("topic", "partition")).count() == 0


def test_a_dead_writers_staging_is_cleared(spark, root):
    rows = records(spark, 10).withColumn("destination", F.col("topic")).withColumn("from_offset", F.lit(0)).withColumn("to_offset", F.lit(9))
    archive.stage_segments(rows, root)
    assert archive.clean_staging(spark, root) == 0 and archive.clean_staging(spark, root, stale_ms=-60_000) == 1
    assert archive.replay(spark, root).count() == 0
    assert mirror.mirror_once(spark, records(spark, 10), root, drain=True, max_offsets=10) == 1


def test_corrupt_chain_stops(spark, root):
    rows = records(spark, 10, first=10).withColumn("destination", F.col("topic")).withColumn("from_offset", F.lit(10)).withColumn("to_offset", F.lit(19))
    archive.commit_segments(spark, root, archive.stage_segments(rows, root))
    with pytest.raises(ValueError, match="corrupt"):
        mirror.mirror_once(spark, records(spark, 30), root, max_offsets=10)


def test_two_mirrors_of_one_log(spark):
    mirrors = spark.createDataFrame([("a", "t", 0, None), ("b", "t", 0, "x")], "name string, topic string, partition int, destination_name_override string")
    with pytest.raises(ValueError, match="more than one"):
        logs.assigned(records(spark, 3), mirrors)


def test_zero_limits_close_every_row(spark):
    log = records(spark, 5)
    for limits in ({"max_offsets": 0}, {"max_bytes": 0}, {"max_time_ms": 0}):
        assert segments.cut(log, **limits).filter("n_records = 1 and closed").count() == 5


def test_cuts_do_not_depend_on_batches(spark):
    log, r = records(spark, 120).cache(), random.Random(3)
    limits = {"max_offsets": 13, "max_bytes": 300, "max_time_ms": 9}
    whole = {(x["from_offset"], x["to_offset"]) for x in segments.cut(log, **limits).filter("closed").collect()}
    done, at = set(), 0
    for upto in sorted(r.sample(range(1, 120), 3)) + [120]:
        new = [(x["from_offset"], x["to_offset"]) for x in segments.cut(log.filter(f"offset >= {at} and offset < {upto}"), **limits).filter("closed").collect()]
        done |= set(new)
        at = max([at, *(b + 1 for _, b in new)])
    assert done == whole


def test_empty_and_missing(spark, root):
    assert archive.replay(spark, root).count() == 0
    assert chains.list_files(spark, root).count() == 0
    none = spark.createDataFrame([], ENVELOPE)
    assert segments.cut(none, max_bytes=10).count() == 0
    assert mirror.mirror_once(spark, none, root, max_offsets=10) == 0


def test_broker_options():
    options = logs.broker_options({"t": {1: 5, 0: 3}}, "host:1")
    assert options["startingOffsets"] == '{"t": {"0": 3, "1": 5}}' and options["assign"] == '{"t": [0, 1]}'


def test_commit_again_after_a_lost_task(spark, root):
    """A task that linked some segments and died is run again: it knows its own links and goes on."""
    rows = segments.by_count(records(spark, 30).withColumn("destination", F.col("topic")), 10)
    ends = rows.groupBy("from_offset").agg(F.max("offset").alias("to_offset"))
    staged = archive.stage_segments(rows.join(ends, "from_offset"), root)
    first = archive.staged_segments(spark, staged).orderBy("first").first()
    folder = os.path.join(plain(root), "t", "0")
    os.makedirs(folder)
    os.link(plain(first["path"]), os.path.join(folder, f"{0:020d}-{9:020d}.parquet"))
    assert archive.commit_segments(spark, root, staged) == 3
    assert names(spark, root) == [f"{a:020d}-{a + 9:020d}.parquet" for a in (0, 10, 20)]
    assert same(archive.replay(spark, root), records(spark, 30))


@pytest.mark.parametrize("by_record", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "ndjson"])
def test_staging_takes_a_folder_per_chain(spark, root, fmt, by_record):
    """However many segments: no folder for each, and nothing of the staging is left."""
    log = records(spark, 200, "a b%+é").unionByName(records(spark, 33, "u", 2))
    rows = segments.by_count(log.withColumn("destination", F.col("topic")), 10)
    rows = rows.join(rows.groupBy("topic", "from_offset").agg(F.max("offset").alias("to_offset")), ["topic", "from_offset"])
    staged = archive.stage_segments(rows, root, fmt, by_record=by_record)
    assert len(list(os.walk(plain(staged)))) == 5
    want = {("a b%+é", "0", i, i + 9) for i in range(0, 200, 10)} | {("u", "2", i, min(i + 9, 32)) for i in range(0, 33, 10)}
    assert {tuple(r)[:4] for r in archive.staged_segments(spark, staged).collect()} == want
    assert archive.commit_segments(spark, root, staged, fmt) == 24
    assert same(archive.replay(spark, root, fmt), log) and same(archive.replay(spark, root, fmt, first=15, last=34), log.filter("offset between 15 and 34"))
    assert {tuple(r) for r in mirror.verified(spark, root, fmt, whole=True).collect()} == {("a b%+é", 0, 200, None), ("u", 2, 33, None)}
    assert by_record or not os.path.exists(plain(staged))


def test_a_segment_of_many_batches(spark, tmp_path):
    """A segment whose rows come in several batches is one file; what a failed attempt leaves is no segment."""
    log = records(spark, 60).withColumns({"_destination": F.col("topic"), "_partition": F.col("partition"), "_from_offset": F.when(F.col("offset") < 45, 0).otherwise(45).cast("bigint"), "_to_offset": F.when(F.col("offset") < 45, 44).otherwise(59).cast("bigint")})
    table = log.select(F.struct(*ENVELOPE.fieldNames()).alias("row"), "_destination", "_partition", "_from_offset", "_to_offset").toArrow().combine_chunks()
    write = archive.written_segments(str(tmp_path), "parquet", "zstd", 600)

    def dies(batches):
        yield from batches[:3]
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        list(write(dies(table.to_batches(max_chunksize=8))))
    assert archive.staged_segments(spark, str(tmp_path)).count() == 0
    for _ in range(2):
        assert sum(b["n"][0].as_py() for b in write(table.to_batches(max_chunksize=8))) == 2
    assert {tuple(r)[:4] for r in archive.staged_segments(spark, str(tmp_path)).collect()} == {("t", "0", 0, 44), ("t", "0", 45, 59)}
    assert same(archive.scan_parquet(spark, str(tmp_path)), records(spark, 60))


def test_runs_of_both_layouts_are_read(spark, root):
    """A run by Spark's writer, with a folder per segment, as on stores and in earlier archives, and then one by tasks."""
    keys = {"_d": F.col("destination"), "_p": F.col("partition"), "_s": F.format_string("%020d-%020d", "from_offset", "to_offset")}
    folder = commit_records.run_folder(root, "old")
    by_tens(spark, 20).withColumns(keys).repartition(1).select(*ENVELOPE.fieldNames(), *keys).write.partitionBy(*keys).parquet(folder)
    assert archive.commit_segments(spark, root, folder) == 2
    assert mirror.mirror_once(spark, records(spark, 47), root, drain=True, max_offsets=10) == 3
    assert same(archive.replay(spark, root), records(spark, 47)) and same(archive.replay(spark, root, first=12, last=33), records(spark, 22, first=12))
    assert {tuple(r)[:3] for r in mirror.verified(spark, root, whole=True).collect()} == {("t", 0, 47)}
    archive_source.register(spark)
    assert same(spark.read.format("tidelog").option("path", root).load(), records(spark, 47))


def test_folders_are_listed_as_sparks_readers_see_them(spark, tmp_path):
    for name in ("x", "a/y", "a/0/z z%+é", "a/0/b/c/deep", "_d=1/_p=2/w", "a/0/.hidden", "_staging/r/no", "a/_no/0/no", ".no/no"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    found = chains.list_files(spark, f"file:{tmp_path}")
    plain_read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert {(r["path"], r["length"], r["modified"]) for r in found.collect()} == {(r["path"], r["length"], r["modificationTime"]) for r in plain_read.collect()}
    assert {(r["dir"].rsplit("/", 1)[-1], r["name"]) for r in found.collect()} == {(tmp_path.name, "x"), ("a", "y"), ("0", "z z%+é"), ("c", "deep"), ("_p=2", "w")}


@pytest.fixture
def store(spark, tmp_path):
    """A folder by a path of another scheme, where nothing is linked or renamed."""
    name = f"store{uuid.uuid4().hex}"
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./bucket", f"file://{tmp_path}")
    return f"viewfs://{name}/bucket/archive"


def by_tens(spark, n, count=10, topic="t"):
    rows = segments.by_count(records(spark, n, topic).withColumn("destination", F.col("topic")), count)
    return rows.join(rows.groupBy("from_offset").agg(F.max("offset").alias("to_offset")), "from_offset")


@pytest.mark.parametrize("fmt", ["parquet", "ndjson"])
def test_archive_on_a_store(spark, store, fmt):
    log = records(spark, 35).unionByName(records(spark, 12, "a b/%+é", 3))
    assert mirror.mirror_once(spark, log.filter("offset < 25"), store, fmt=fmt, max_offsets=10) == 3
    assert mirror.mirror_once(spark, log, store, fmt=fmt, drain=True, max_offsets=10) == 3
    assert mirror.mirror_once(spark, log, store, fmt=fmt, drain=True, max_offsets=10) == 0
    assert same(archive.replay(spark, store, fmt), log)
    assert same(archive.replay(spark, store, fmt, first=8, last=21), log.filter("offset between 8 and 21"))
    found = archive.archived(spark, store)
    assert sorted((r["topic"], r["partition"], r["name"]) for r in found.collect()) == sorted([("t", 0, f"{a:020d}-{b:020d}.{fmt}") for a, b in ((0, 9), (10, 19), (20, 29), (30, 34))] + [("a b/%+é", 3, f"{a:020d}-{b:020d}.{fmt}") for a, b in ((0, 9), (10, 11))])
    assert chains.violations(found, fmt, ("topic", "partition")).count() == 0
    assert {tuple(r) for r in mirror.positions(spark, store, fmt).collect()} == {("t", 0, 35), ("a b/%+é", 3, 12)}
    assert {tuple(r)[:3] for r in mirror.verified(spark, store, fmt, whole=True).collect()} == {("t", 0, 35), ("a b/%+é", 3, 12)}


def test_of_two_writers_to_a_store_one_commits(spark, store):
    ten, seven = archive.stage_segments(by_tens(spark, 40), store), archive.stage_segments(by_tens(spark, 40, 7), store)
    assert archive.replay(spark, store).count() == 0
    assert archive.commit_segments(spark, store, ten) == 4
    assert archive.commit_segments(spark, store, ten) == 4  # a commit whose answer was lost is asked for again
    with pytest.raises(FileExistsError):
        archive.commit_segments(spark, store, seven)
    assert same(archive.replay(spark, store), records(spark, 40)) and archive.archived(spark, store).count() == 4
    assert archive.clean_staging(spark, store) == 0 and archive.clean_staging(spark, store, stale_ms=-60_000) == 1
    assert same(archive.replay(spark, store), records(spark, 40))


def test_writers_that_meet_at_a_record(spark, store, monkeypatch):
    """Both have seen the same position: creating the record decides."""
    ten, seven = archive.stage_segments(by_tens(spark, 40), store), archive.stage_segments(by_tens(spark, 40, 7), store)
    assert archive.commit_segments(spark, store, ten) == 4
    monkeypatch.setattr(commit_records, "next_of", lambda files, folder: 0)
    with pytest.raises(FileExistsError, match="another writer"):
        archive.commit_segments(spark, store, seven)


def test_a_commit_takes_as_many_calls_for_many_segments(spark, store, monkeypatch):
    calls = []
    for name in ("create", "names", "exists", "text", "delete"):
        monkeypatch.setattr(Files, name, lambda self, *a, f=getattr(Files, name): (calls.append(a), f(self, *a))[1])
    counts = []
    for n, topic in ((20, "few"), (400, "many")):
        staged = archive.stage_segments(by_tens(spark, n, topic=topic), store, by_record=True)
        written = spark.createDataFrame([(topic, 0, 0, n - 1, n // 10)], "destination string, partition int, first bigint, last bigint, segments bigint")
        calls.clear()
        assert archive.commit_segments(spark, store, staged, written=written) == n // 10
        counts.append(len(calls))
    assert counts[0] == counts[1] <= 4


def test_records_with_a_gap_and_empty_records(spark, store):
    files = Files(spark, store)
    for first, text in ((0, '{"destination":"t","partition":0,"run":"a","first":0,"last":9,"segments":1,"format":"parquet"}'), (20, '{"destination":"t","partition":0,"run":"b","first":20,"last":29,"segments":1,"format":"parquet"}'), (30, "")):
        files.create(f"{store}/{commit_records.COMMITS}/t/0/{first:020d}.json", text)
    assert commit_records.next_of(files, f"{store}/{commit_records.COMMITS}/t/0") == 30
    with pytest.raises(ValueError, match="corrupt chain"):
        mirror.positions(spark, store)


def test_a_store_without_exclusive_creation_is_refused(spark, store, monkeypatch):
    files = Files(spark, store)
    files.create(f"{store}/x", "mine")
    files.create(f"{store}/x", "mine")
    with pytest.raises(FileExistsError, match="another writer"):
        files.create(f"{store}/x", "other")
    monkeypatch.setattr(storage, "EXCLUSIVE", ())
    with pytest.raises(ValueError, match="only one writer"):
        files.create(f"{store}/y", "mine")


def test_cut_equals_row_by_row(spark):
    """Rows, bytes and times at random, null and backward times among them, against the rule applied row by row.

    A log is one stretch, or many that segments lie in, cross or span; some logs begin late.
    """
    r = random.Random(11)
    rows = []
    for partition in range(3):
        now = 1000
        for i in range(700):
            now += r.choice([-40, 0, 1, 5, 30])
            rows.append(("t", partition, i + 90 * partition, None if r.random() < (0.2, 0.9, 0.5)[partition] else now, "create_time", None, bytes(r.choice([0, 0, 3, 50])), []))
    log = spark.createDataFrame(rows, ENVELOPE).cache()
    far = 2**62
    for most, size, age, stretch in ((9, 90, 60, far), (5, 0, 10, far), (400, 4000, 0, 64), (9, 90, 60, 16), (far, 200, far, 7), (far, far, 25, 3), (1, 1, 1, 5), (far, far, 2500, 11), (far, 4000, 900, 1), (500, far, 10**6, 50)):
        want = []
        for partition in range(3):
            seg = None
            for _, p, i, t, _, _, value, _ in rows:
                if p != partition:
                    continue
                seg = seg or {"first": i, "n": 0, "bytes": 0, "since": None, "top": None}
                seg["n"], seg["bytes"] = seg["n"] + 1, seg["bytes"] + len(value)
                if t is not None:
                    seg["since"] = t if seg["since"] is None else seg["since"]
                    seg["top"] = t if seg["top"] is None else max(seg["top"], t)
                if seg["n"] >= most or seg["bytes"] >= size or (seg["since"] is not None and seg["top"] - seg["since"] >= age):
                    want.append((p, seg["first"], i, seg["n"], seg["bytes"], True))
                    seg = None
            if seg:
                want.append((partition, seg["first"], 699 + 90 * partition, seg["n"], seg["bytes"], False))
        assert len(want) >= 3
        got = segments.cut(log, most, size, age, stretch=stretch).select("partition", "from_offset", "to_offset", "n_records", "buffered_bytes", "closed")
        assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_gate_in_stretches(spark):
    """Short stretches find what one window over each log finds, between stretches too."""
    r = random.Random(5)
    rows = [("t", p, i) for p in (0, 1) for i in range(200) for _ in range(r.choice([0, 1, 1, 1, 1, 2]))]
    log, at = spark.createDataFrame(rows, "topic string, partition int, offset long"), spark.createDataFrame([("t", 0, 3)], "topic string, partition int, next_offset long")
    for bits in (0, 2, 5, 20):
        want = []
        for p, start in ((0, 3), (1, 0)):
            expected = start
            for i in sorted(o for _, q, o in rows if q == p):
                want += [("t", p, expected, i)] if i != expected else []
                expected = i + 1
        assert sorted(tuple(x) for x in chains.gate_contiguous(log, at, bits=bits).collect()) == sorted(want)


def test_text_order_is_cut_into_stretches(spark):
    words = [f"{chr(97 + i % 26)}{i:05}" for i in range(300)] + ["", "é", "é"]
    log = spark.createDataFrame([("t", 0, w) for w in words] + [("t", 0, None)], "topic string, partition int, w string")
    found = logs.make_log(log, ["w"], 16).orderBy("offset").collect()
    assert [x["offset"] for x in found] == list(range(304)) and [x["w"] for x in found] == [None, *sorted(words)]


def test_replay_opens_only_what_it_needs(spark, root):
    mirror.mirror_once(spark, records(spark, 100), root, drain=True, max_offsets=10)
    folder = os.path.join(plain(root), "t", "0")
    open(os.path.join(folder, "notes.parquet"), "w").close()  # not a segment
    for f in glob.glob(f"{folder}/**/{0:020d}-{9:020d}.parquet", recursive=True) + glob.glob(f"{folder}/**/.{0:020d}-{9:020d}.parquet.crc", recursive=True):
        os.remove(f)  # it may be linked to what staging holds
        if not f.endswith(".crc"):
            with open(f, "wb") as out:
                out.write(b"garbage" * 100)
    assert same(archive.replay(spark, root, first=25, last=44), records(spark, 20, first=25))
    with pytest.raises(Exception, match="(?i)parquet"):
        archive.replay(spark, root, first=5, last=44).collect()


def test_stream_with_a_lost_checkpoint(spark, root):
    source = f"{root}-source"
    for n, (low, high) in enumerate(((0, 25), (25, 47), (47, 80))):
        records(spark, high - low, first=low).write.mode("append").parquet(source)
        mirror_stream(spark, source, root, f"{root}-checkpoint-{n}", files_per_batch=1, max_offsets=10).awaitTermination()
    assert names(spark, root) == [f"{a:020d}-{a + 9:020d}.parquet" for a in range(0, 80, 10)]
    assert same(archive.replay(spark, root), records(spark, 80))


def test_status_keeps_other_rows(spark, root):
    mirror.mirror_once(spark, records(spark, 20).unionByName(records(spark, 20, topic="u")), root, max_offsets=10)
    stray = records(spark, 1, first=50).withColumns({"destination": F.lit("u"), "from_offset": F.lit(50), "to_offset": F.lit(50)})
    archive.commit_segments(spark, root, archive.stage_segments(stray, root))
    found = {r["topic"]: (r["next_offset"], r["error"]) for r in mirror.verified(spark, root).collect()}
    assert found == {"t": (20, None), "u": (None, "gap_or_overlap at 50-50")}


# -- streams, audits, appends --------------------------------------------------------------------------------------


def test_a_stream_opens_only_tails_and_batch(spark, root, monkeypatch):
    """Logs in ten files; the slow one is in the first and the last file alone, and its tail stays open all along."""
    source, opened = f"{root}-source", []
    for i in range(10):
        rows = records(spark, 10, "a", 0, 10 * i).unionByName(records(spark, 10, "a", 1, 10 * i)).unionByName(records(spark, 10, "b", 0, 10 * i))
        if i in (0, 9):
            rows = rows.unionByName(records(spark, 3, "slow", 0, 0 if i == 0 else 3))
        rows.coalesce(1).write.mode("append").parquet(source)
    whole = streaming_mirror.FileRanges.rows
    monkeypatch.setattr(streaming_mirror.FileRanges, "rows", lambda self, bounds: (whole(self, bounds), opened.append(len(self.opened)))[0])
    mirror_stream(spark, source, root, f"{root}-checkpoint", files_per_batch=1, max_offsets=10).awaitTermination()
    assert opened == [1] * 9 + [2]
    assert archive.archived(spark, root).count() == 30
    mirror.mirror_once(spark, spark.read.schema(ENVELOPE).parquet(source), root, drain=True, max_offsets=10)
    assert archive.replay(spark, root).count() == 306


def test_a_lost_index_costs_a_full_read_but_no_row(spark, root):
    source, checkpoint = f"{root}-source", f"{root}-checkpoint"
    for i in range(3):
        records(spark, 7, first=7 * i).coalesce(1).write.mode("append").parquet(source)
        mirror_stream(spark, source, root, checkpoint, files_per_batch=1, max_offsets=10).awaitTermination()
        Files(spark, root).delete(f"{checkpoint}-ranges")
    assert same(archive.replay(spark, root), records(spark, 20))


def test_150_batches_are_counted_in_full(spark, root):
    """More batches than Spark keeps reports of; a batch that is tried again counts once."""
    source, seen, tries = f"{root}-source", MirrorProgress(), []
    spark.range(150).selectExpr("id", "cast(id % 3 as int) as p").repartition(150, "id").write.option("maxRecordsPerFile", 1).parquet(source)

    def handle(batch, batch_id):
        rows = [("t", r["p"], r["n"], r["n"] * 2, 1, r["n"]) for r in batch.groupBy("p").count().withColumnRenamed("count", "n").collect()]
        seen.seen(batch_id, rows)
        tries.append(batch_id)

    spark.streams.addListener(seen)
    query = spark.readStream.schema("id bigint, p int").option("maxFilesPerTrigger", 1).parquet(source).writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}-c").trigger(availableNow=True).start()
    seen.run = str(query.runId)
    query.awaitTermination()
    assert seen.over.wait(60)
    spark.streams.removeListener(seen)
    assert seen.batches == len(set(tries)) == 150 and len(query.recentProgress) <= 100
    assert {tuple(r)[:5] for r in seen.table(spark).collect()} == {("t", p, 50, 100, 50) for p in range(3)}


def test_equal_archives_are_audited_by_digests_alone(spark, monkeypatch):
    log = records(spark, 100).unionByName(records(spark, 30, "u", 2))
    monkeypatch.setattr(reports, "_audit_rows", None)
    found = reports.audit(log, log.repartition(5), bits=3)
    assert {tuple(r) for r in found.collect()} == {("t", 0, 100, 100, 0, 0, 0), ("u", 2, 30, 30, 0, 0, 0)}


def test_audits_find_every_kind_of_difference(spark):
    """Nulls that move between columns or within headers differ; only the blocks that differ are looked at row by row."""
    def rows(changes):
        base = {i: ("t", 0, i, 5, "create_time", b"k", b"v", [("a", b"x")]) for i in range(200)}
        return spark.createDataFrame([r for r in (base | changes).values() if r], ENVELOPE)

    changes = [(b"v", None), (None, b"v"), (b"", b"v"), (b"k", None), (b"kv", b"")]
    source = rows({i: ("t", 0, i, 5, "create_time", k, v, [("a", None), ("b", b"x")]) for i, (k, v) in enumerate(changes)})
    for other in changes:
        own = rows({i: ("t", 0, i, 5, "create_time", *other, [("a", None), ("b", b"x")]) for i in range(5)})
        assert tuple(reports.audit(source, own, bits=4).first())[4:] == (0, 0, 4)
    heads = [[("a", None), ("b", b"x")], [("a", b"b"), ("x", None)], [("a", None), ("b", None), ("x", None)], [], None, [(None, None)]]
    for i, a in enumerate(heads):
        for j, b in enumerate(heads):
            two = [rows({7: ("t", 0, 7, 5, "create_time", None, None, h)}) for h in (a, b)]
            assert tuple(reports.audit(*two, bits=4).first()) == ("t", 0, 200, 200, 0, 0, int(i != j))
    more = rows({150: None, 151: None, 500: ("t", 0, 500, 5, "create_time", None, None, []), 501: ("t", 1, 0, 5, "create_time", None, None, [])})
    for few in (0, 1000):
        assert {tuple(r) for r in reports.audit(rows({}), more, bits=4, most=few).collect()} == {("t", 0, 200, 199, 2, 1, 0), ("t", 1, 0, 1, 0, 1, 0)}


def test_of_two_appends_one_becomes_the_next_version(spark, root, monkeypatch):
    log = records(spark, 40)
    log.filter("offset < 10").write.parquet(root)
    assert mirror.append_once(spark, log.filter("offset < 20"), root, "source", 1) == 10
    assert mirror.append_once(spark, log.filter("offset < 20"), root, "source", 1) == 0
    before = mirror.log_table(spark, root)
    monkeypatch.setattr(mirror, "latest_version", lambda files, real=mirror.latest_version: min(real(files), 1))
    assert mirror.append_once(spark, log.filter("offset < 30"), root, "source", 1) == 10
    with pytest.raises(FileExistsError, match="another writer"):  # it has seen version 1 too
        mirror.append_once(spark, log, root, "source", 1)
    monkeypatch.undo()
    assert sorted(r["offset"] for r in mirror.log_table(spark, root).collect()) == list(range(30))
    assert before.count() == 20 and mirror.log_table(spark, root, 1).count() == 20
    assert mirror.append_once(spark, log, root, "source", 1) == 10
    assert mirror.latest_version(Files(spark, root)) == 3


def test_appends_to_nothing_and_with_a_gap(spark, root):
    assert mirror.append_once(spark, records(spark, 5), root, "source", 1) == 5
    with pytest.raises(ValueError, match="position"):
        mirror.append_once(spark, records(spark, 5, first=7), root, "source", 1)
    assert mirror.log_table(spark, root).count() == 5


def wait_for(what, seconds=90):
    end = time.time() + seconds
    while not (found := what()):
        assert time.time() < end
        time.sleep(0.5)
    return found


def test_a_stopped_stream_drains_its_open_tails(spark, root):
    source = f"{root}-source"
    records(spark, 25).unionByName(records(spark, 3, "u")).coalesce(1).write.parquet(source)
    options = {"available_now": False, "interval": "1 second", "max_offsets": 10}
    query = mirror_stream(spark, source, root, f"{root}-c", **options)
    wait_for(lambda: archive.archived(spark, root).count() == 2)
    assert stop_mirror(query) == 2 and not query.isActive
    assert same(archive.replay(spark, root), records(spark, 25).unionByName(records(spark, 3, "u")))
    records(spark, 8, first=25).coalesce(1).write.mode("append").parquet(source)
    query = mirror_stream(spark, source, root, f"{root}-c", **options)
    wait_for(lambda: query.lastProgress and query.lastProgress.batchId >= 1)
    assert stop_mirror(query, drain=False) == 0 and archive.archived(spark, root).count() == 4
    mirror_stream(spark, source, root, f"{root}-c", max_offsets=8).awaitTermination()
    mirror.mirror_once(spark, spark.read.schema(ENVELOPE).parquet(source), root, drain=True, max_offsets=8)
    assert archive.replay(spark, root).count() == 36 and chains.violations(archive.archived(spark, root), "parquet", ("topic", "partition")).count() == 0


def test_the_heartbeat_beats_without_input_and_finds_drift(spark, root):
    """Rows 20 to 24 stay open; somebody else archives them while the mirror is idle."""
    source, beats, seen = f"{root}-source", f"{root}-beats", MirrorProgress()
    records(spark, 25).coalesce(1).write.parquet(source)
    query = mirror_stream(spark, source, root, f"{root}-c", available_now=False, interval="1 second", progress=seen, max_offsets=10)
    wait_for(lambda: seen.batches)
    heart = heartbeat(query, "1 second", beats)
    rows = wait_for(lambda: Files(spark, root).exists(beats) and (lambda r: r if len(r) >= 3 else None)(spark.read.parquet(beats).orderBy("beat").collect()))
    assert {(r["topic"], r["partition"], r["expected"]) for r in rows} == {("t", 0, 20)}
    assert [r["n_records"] for r in rows] == [25] + [0] * (len(rows) - 1)
    mirror.mirror_once(spark, records(spark, 25), root, drain=True, max_offsets=10)
    with pytest.raises(Exception, match="destination drift"):
        heart.awaitTermination(90)
    assert not query.isActive
    spark.streams.removeListener(seen)


# -- the data source -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("by_record", [False, True])
def test_the_source_reads_in_order_without_a_shuffle(spark, root, by_record):
    archive_source.register(spark)
    log = records(spark, 95).unionByName(records(spark, 40, "a b", 3))
    mirror.mirror_once(spark, log, root, drain=True, by_record=by_record, max_offsets=10)
    read = spark.read.format("tidelog").option("path", root).option("task_bytes", 1 << 14)
    df = read.load()
    assert same(df, log)
    parts = df.select("topic", "partition", "offset").rdd.glom().collect()
    assert len(parts) > 2
    for own in parts:
        assert len({tuple(r)[:2] for r in own}) <= 1 and [r["offset"] for r in own] == sorted(r["offset"] for r in own)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    some = read.option("starts", '{"t": {"0": 33}, "none": {"0": 1}}').load()
    assert same(some, log.filter("topic = 't' and offset >= 33"))
    assert same(df.filter("topic = 'a b' and partition = 3 and offset > 8"), log.filter("topic = 'a b' and offset > 8")) and same(df, log)
    assert spark.read.format("tidelog").option("path", root).option("first", 1000).load().count() == 0
    assert read.option("path", f"{root}-none").load().count() == 0


def test_the_source_opens_only_segments_in_range(spark, root):
    archive_source.register(spark)
    mirror.mirror_once(spark, records(spark, 60), root, drain=True, max_offsets=10)
    with open(f"{plain(root)}/t/0/{0:020d}-{9:020d}.parquet", "wb") as f:
        f.write(b"garbage")
    read = spark.read.format("tidelog").option("path", root)
    with pytest.raises(Exception):  # noqa: B017
        read.load().collect()
    assert same(read.option("first", 12).option("last", 48).load(), records(spark, 37, first=12))
    assert same(archive.replay(spark, root, first=25, last=44), records(spark, 20, first=25))


def test_the_source_streams_on_after_a_restart(spark, root):
    archive_source.register(spark)
    log, seen = records(spark, 60), []

    def run():
        stream = spark.readStream.format("tidelog").option("path", root).option("starts", '{"t": {"0": 5}}').load()
        query = stream.writeStream.foreachBatch(lambda b, _: seen.append([r["offset"] for r in b.collect()])).option("checkpointLocation", f"{root}-c").trigger(availableNow=True).start()
        query.awaitTermination(120)

    for upto in (22, 41, 60):
        mirror.mirror_once(spark, log.filter(f"offset < {upto}"), root, max_offsets=10)
        run()
    assert [o for b in seen for o in b] == list(range(5, 60))
