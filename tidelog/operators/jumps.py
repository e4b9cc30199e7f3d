"""Cutting one log over many tasks: jump tables.

Where a segment ends follows from where it begins, so the cut of a log is one long chain of dependent steps. A log is
therefore taken in stretches of its offsets. For every row of a stretch, searches in running sums tell where a segment
that begins there closes, and pointer doubling tells where the chain of segments from that row leaves the stretch: in a
segment that is still open at its end (a crossing), or exactly between two stretches. Summaries of the stretches tell in
which later stretch each crossing closes, and there, which crossing follows; that is a table of jumps from crossing to
crossing. Doubling the jumps marks those that the log's own chain takes, in as many rounds as the number of stretches
has bits, and then every stretch knows how it is entered and emits its segments.

Crossings are at most the rows of a segment per stretch; summaries are a row per stretch, and cut() chooses the stretch
so that there are at most MOST_STRETCHES of those.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidelog.plans.storage import stored
from tidelog.schema import LOG

ENDLESS = 2**62
#: Stretches of logs that have more than one: bounds what is sent to tasks (some 50 bytes each).
MOST_STRETCHES = 200_000
LOGS = "topic string, partition int"
SEGMENTS = f"{LOGS}, from_offset bigint, to_offset bigint, n_records bigint, buffered_bytes bigint, closed boolean"
_NUMBERS = [("stretch", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("first_time", pa.float64()), ("max_time", pa.float64()), ("leaves", pa.int64()), ("between", pa.bool_()), ("sizes", pa.binary()), ("times", pa.binary())]
PACKED = pa.schema([("topic", pa.string()), ("partition", pa.int32()), *_NUMBERS, ("crossing", pa.list_(pa.int64())), ("crossing_bytes", pa.list_(pa.int64())), ("crossing_since", pa.list_(pa.float64()))])


class Limits(NamedTuple):
    rows: int = ENDLESS
    bytes: int = ENDLESS
    time: int = ENDLESS


class Highest:
    """Finds the first value at or after a place that reaches a bound, for many places at once."""

    def __init__(self, values: np.ndarray):
        top = np.where(np.isnan(values), -np.inf, values)
        self.n, self.tops = len(values), [top]
        while 2 << (len(self.tops) - 1) <= self.n:
            half = 1 << (len(self.tops) - 1)
            top = np.maximum(top[:-half], top[half:])
            self.tops.append(top)

    def first(self, begin: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Index of the first value of at least bound from begin on, or the number of values; a NaN bound is never reached."""
        at = np.minimum(begin, self.n)
        for level in reversed(range(len(self.tops))):
            width, top = 1 << level, self.tops[level]
            lower = ~(top[np.minimum(at, len(top) - 1)] >= bound)
            at = at + width * ((at + width <= self.n) & lower)
        return at


def next_known(times: np.ndarray) -> np.ndarray:
    """The first known time at or after each place, or NaN."""
    known = np.flatnonzero(~np.isnan(times))
    at = np.searchsorted(known, np.arange(len(times)))
    return np.append(times[known], np.nan)[at] if len(times) else times


class Stretch:
    """Some consecutive rows of a log: sizes, and times with NaN for null."""

    def __init__(self, sizes: np.ndarray, times: np.ndarray, limits: Limits):
        self.n, self.limits = len(sizes), limits
        self.upto = np.concatenate([[0], np.cumsum(sizes)])
        if limits.time < ENDLESS:
            self.times, self.highest = next_known(times), Highest(times)

    def closing(self, begin: np.ndarray, rows: np.ndarray | int = 0, held: np.ndarray | int = 0, since: np.ndarray | float = np.nan) -> np.ndarray:
        """The row that closes the segment which has `rows` rows, `held` bytes and first time `since` before row begin; n if none here does."""
        at = np.minimum(begin + (max(1, self.limits.rows) - rows) - 1, self.n)
        if self.limits.bytes < ENDLESS:
            full = np.searchsorted(self.upto, self.upto[begin] + (self.limits.bytes - held)) - 1
            at = np.minimum(at, np.maximum(full, begin))
        if self.limits.time < ENDLESS:
            first = np.where(np.isnan(since), self.times[np.minimum(begin, self.n - 1)], since)
            at = np.minimum(at, self.highest.first(begin, first + self.limits.time))
        return at

    def next(self) -> np.ndarray:
        """For each row the row after the segment that begins there; n + 1 if that crosses the end of the stretch."""
        return self.closing(np.arange(self.n)) + 1

    def exits(self) -> np.ndarray:
        """For each row the crossing's first row in which its chain leaves the stretch; n if it leaves between two segments."""
        jump = np.append(self.next(), self.n)
        crossing = jump > self.n
        jump[crossing] = np.flatnonzero(crossing)
        while not np.array_equal(further := jump[jump], jump):
            jump = further
        return jump


def _packed(limits: Limits, step: int):
    """A stretch's rows as one row: its summary, sizes, times, and its crossings (first offset, bytes from there, first time)."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("offset").combine_chunks()
        offsets, sizes = rows["offset"].to_numpy(), rows["size"].to_numpy().astype(np.int64)
        times = rows["timestamp_ms"].cast(pa.float64()).to_numpy()
        s, n = Stretch(sizes, times, limits), len(sizes)
        crossing = np.flatnonzero(s.next() > n)
        known = times[~np.isnan(times)]
        since = s.times[crossing] if limits.time < ENDLESS else np.full(len(crossing), np.nan)
        leaves = s.exits()[0]
        of = {
            "topic": [rows["topic"][0].as_py()], "partition": [rows["partition"][0].as_py()], "stretch": [int(offsets[0]) // step],
            "first": [int(offsets[0])], "n": [n], "bytes": [int(s.upto[-1])], "first_time": [float(known[0]) if len(known) else None], "max_time": [float(known.max()) if len(known) else None],
            "leaves": [int(offsets[0] + leaves)], "between": [bool(leaves == n)],
            "sizes": [sizes.astype("<i8").tobytes()], "times": [times.astype("<f8").tobytes()],
            "crossing": [offsets[crossing]], "crossing_bytes": [s.upto[-1] - s.upto[crossing]], "crossing_since": [since],
        }
        return pa.table(of, schema=PACKED)

    return pack


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The batches' rows one by one, lists as arrays."""
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(name)[i] for name in b.schema.names}
            yield {name: v.values.to_numpy() if isinstance(v, pa.ListScalar) else v.as_py() for name, v in row.items()}


class Summary:
    """The stretches of one log, in order."""

    def __init__(self, rows: list[tuple]):
        columns = [np.array(c, float if i > 3 else np.int64) for i, c in enumerate(zip(*sorted(rows), strict=True))]
        self.stretch, first, n, size, first_time, max_time = columns
        self.end = first[-1] + n[-1]
        self.ends = np.cumsum(size)
        self.known, self.highest = next_known(first_time), Highest(max_time)

    def targets(self, k: int, s: np.ndarray, own: np.ndarray, since: np.ndarray, limits: Limits, step: int) -> tuple[np.ndarray, ...]:
        """For crossings of the k-th stretch: place of the stretch where each closes (or one past the last), the bytes before it, first time."""
        last, n = len(self.stretch), len(s)
        at = np.full(n, last)
        if limits.rows < ENDLESS:
            closing = s + max(1, limits.rows) - 1
            at = np.where(closing < self.end, np.searchsorted(self.stretch, closing // step), last)
        begin = self.ends[k] - own
        if limits.bytes < ENDLESS:
            at = np.minimum(at, np.searchsorted(self.ends, begin + limits.bytes))
        if k + 1 < last:
            since = np.where(np.isnan(since), self.known[k + 1], since)
        if limits.time < ENDLESS:
            at = np.minimum(at, self.highest.first(np.full(n, k + 1), since + limits.time))
        at = np.maximum(at, k + 1)
        before = np.concatenate([[0], self.ends])[at] - begin
        return at, before, since


def _ids(offset: Column | str, between: Column) -> Column:
    """A crossing, or a place between two stretches, as one number."""
    return F.col(offset) * 2 + between.cast("bigint") if isinstance(offset, str) else offset * 2 + between.cast("bigint")


def cut(narrow: DataFrame, limits: Limits, step: int = 1 << 17) -> DataFrame:
    """The segments (as segments.cut has them) of narrow (topic, partition, offset, size, timestamp_ms); offsets must be dense.

    step: rows of a stretch, more if there would be too many stretches.
    """
    rows = narrow.groupBy(*LOG).agg(F.count("*").alias("n"))
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    step = max(step, -(-total // MOST_STRETCHES))
    dealt = narrow.select(*LOG, "offset", "size", "timestamp_ms", F.floor(F.col("offset") / step).cast("bigint").alias("_stretch"))
    packed = stored(dealt.groupBy(*LOG, "_stretch").applyInArrow(_packed(limits, step), from_arrow_schema(PACKED)), "stretches")

    ranks = packed.groupBy(*LOG).agg(F.min("first").alias("first"), F.count("*").alias("n_stretches"), F.max(F.col("first") + F.col("n")).alias("end"))
    entries = ranks.select(*LOG, F.col("first").alias("begin"), F.floor(F.col("first") / step).cast("bigint").alias("stretch"), F.lit(None).cast("bigint").alias("from_offset"), F.lit(0).cast("bigint").alias("held"))
    longer = ranks.filter("n_stretches > 1")
    known: dict[tuple, list] = {}
    for r in packed.join(longer.select(*LOG), LOG).select(*LOG, "stretch", "first", "n", "bytes", "first_time", "max_time").toLocalIterator():
        known.setdefault((r["topic"], r["partition"]), []).append((r["stretch"], r["first"], r["n"], r["bytes"], np.nan if r["first_time"] is None else r["first_time"], np.nan if r["max_time"] is None else r["max_time"]))
    open_tails = None
    if known:
        followed, open_tails = _follow(packed, longer, known, limits, step)
        entries = entries.unionByName(followed)
    found = packed.select(*LOG, "stretch", "first", "n", "sizes", "times").join(entries, [*LOG, "stretch"]).join(ranks.select(*LOG, "end"), LOG)
    found = found.mapInArrow(_emit(limits), SEGMENTS)
    return found.unionByName(open_tails) if open_tails is not None else found



def _emit(limits: Limits):
    """Segments that close in a stretch, from the row `begin` on after the one that came in open; in a log's last stretch its open one too."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            s = Stretch(np.frombuffer(r["sizes"], "<i8"), np.frombuffer(r["times"], "<f8"), limits)
            first, begin, out = r["first"], r["begin"] - r["first"], []
            if r["from_offset"] is not None:
                out.append((r["from_offset"], r["begin"] - 1, r["held"] + int(s.upto[begin]), True))
            jump = s.next().tolist()
            while begin < s.n:
                after, closed = jump[begin], True
                if after > s.n:
                    if first + s.n < r["end"]:
                        break
                    after, closed = s.n, False
                out.append((first + begin, first + after - 1, int(s.upto[after] - s.upto[begin]), closed))
                begin = after
            if out:
                begins, ends, sizes, closed = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([r["topic"]] * len(out), pa.string()), pa.array([r["partition"]] * len(out), pa.int32()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64()), pa.array([e - i + 1 for i, e in zip(begins, ends, strict=True)], pa.int64()), pa.array(sizes, pa.int64()), pa.array(closed, pa.bool_())], names=[*LOG, "from_offset", "to_offset", "n_records", "buffered_bytes", "closed"])

    return emit


def _follow(packed: DataFrame, longer: DataFrame, known: dict[tuple, list], limits: Limits, step: int) -> tuple[DataFrame, DataFrame]:
    """How the chains of longer logs enter their stretches (but the first), and their segments that never close and began before the last stretch."""
    summaries = packed.sparkSession.sparkContext.broadcast(known)

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple, Summary] = {}
        for r in _rows(batches):
            log = (r["topic"], r["partition"])
            if log not in made:
                made = {log: Summary(summaries.value[log])}
            summary = made[log]
            k = int(np.searchsorted(summary.stretch, r["stretch"]))
            if k + 1 == len(summary.stretch):
                continue
            s = r["crossing"]
            at, before, since = summary.targets(k, s, r["crossing_bytes"], r["crossing_since"], limits, step)
            for target in np.unique(at).tolist():
                here = at == target
                last = target == len(summary.stretch)
                yield pa.RecordBatch.from_pydict({"topic": pa.array([log[0]], pa.string()), "partition": pa.array([log[1]], pa.int32()), "stretch": pa.array([None if last else int(summary.stretch[target])], pa.int64()), "s": pa.array([s[here]], pa.list_(pa.int64())), "held": pa.array([before[here]], pa.list_(pa.int64())), "since": pa.array([since[here]], pa.list_(pa.float64()))})

    aimed = stored(packed.join(longer.select(*LOG), LOG).select(*LOG, "stretch", "crossing", "crossing_bytes", "crossing_since").mapInArrow(aim, f"{LOGS}, stretch bigint, s array<bigint>, held array<bigint>, since array<double>"), "crossings")

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            stretch = Stretch(np.frombuffer(r["sizes"], "<i8"), np.frombuffer(r["times"], "<f8"), limits)
            s, held, since = r["s"], r["held"], r["since"]
            after = stretch.closing(np.zeros(len(s), np.int64), r["first"] - s, held, since) + 1
            leaves = stretch.exits()[after]
            between = leaves == stretch.n
            yield pa.RecordBatch.from_arrays([pa.array([r["topic"]] * len(s), pa.string()), pa.array([r["partition"]] * len(s), pa.int32()), pa.array(2 * s), pa.array(2 * (r["first"] + leaves) + between), pa.array([r["stretch"]] * len(s), pa.int64()), pa.array(r["first"] + after), pa.array(held)], names=[*LOG, "id", "to", "stretch", "begin", "held"])

    landed = aimed.filter("stretch is not null").join(packed.select(*LOG, "stretch", "first", "n", "sizes", "times"), [*LOG, "stretch"])
    jumps = stored(landed.mapInArrow(land, f"{LOGS}, id bigint, to bigint, stretch bigint, begin bigint, held bigint"), "jumps")
    fresh = packed.join(longer.select(*LOG), LOG).select(*LOG, _ids("first", F.lit(True)).alias("id"), _ids("leaves", F.col("between")).alias("to"))
    step_table = jumps.select(*LOG, "id", "to").unionByName(fresh)
    taken = longer.select(*LOG, _ids("first", F.lit(True)).alias("id"))
    for _ in range((2 * max(len(x) for x in known.values())).bit_length() + 1):
        taken = taken.unionByName(taken.join(step_table, [*LOG, "id"]).select(*LOG, F.col("to").alias("id"))).checkpoint()
        following = step_table.select(*LOG, F.col("id").alias("to"), F.col("to").alias("far"))
        step_table = step_table.join(following, [*LOG, "to"]).select(*LOG, "id", F.col("far").alias("to")).checkpoint()
    crossed = jumps.join(taken, [*LOG, "id"], "left_semi").select(*LOG, "begin", "stretch", F.shiftright("id", 1).alias("from_offset"), "held")
    between = packed.join(taken.filter("id % 2 = 1").select(*LOG, F.shiftright("id", 1).alias("first")), [*LOG, "first"], "left_semi").join(longer.select(*LOG, F.col("first").alias("_first")), LOG).filter("first != _first")
    between = between.select(*LOG, F.col("first").alias("begin"), "stretch", F.lit(None).cast("bigint").alias("from_offset"), F.lit(0).cast("bigint").alias("held"))
    tails = aimed.filter("stretch is null").select(*LOG, F.inline(F.arrays_zip("s", "held"))).withColumn("id", F.col("s") * 2).join(taken, [*LOG, "id"], "left_semi").join(longer.select(*LOG, "end"), LOG)
    tails = tails.select(*LOG, F.col("s").alias("from_offset"), (F.col("end") - 1).alias("to_offset"), (F.col("end") - F.col("s")).alias("n_records"), F.col("held").alias("buffered_bytes"), F.lit(False).alias("closed"))
    return crossed.unionByName(between), tails
