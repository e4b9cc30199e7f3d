"""Small helpers shared by the operators: tables, label folds, cut lineage, word splitting."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.plans.storage import shared_dir

U64 = np.uint64
#: Odd multipliers of the 64-bit mixers (public splitmix64 constants).
MIX1, MIX2, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of the column's text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and what a lost executor held is still there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete what settled or bucketed has written; nothing that is still to run may read it."""
    for df in tables:
        spark = df.sparkSession
        if getattr(df, "_table", None):
            spark.sql(f"drop table if exists {df._table}")
        path = spark._jvm.org.apache.hadoop.fs.Path(df._settled)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """df as a table in the shared folder, bucketed by key: joins on the key don't shuffle it again."""
    spark = df.sparkSession
    table_name = f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/{table_name}"
    df.write.option("path", path).option("compression", "zstd").bucketBy(n, key).sortBy(key).saveAsTable(table_name)
    out = spark.table(table_name)
    out._settled, out._table = path, table_name
    return out


def with_free_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the named columns, so that extra columns of the input, whatever their names, can't clash with ours."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def by_size(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """df, broadcast only if it has at most most_rows rows (of ids: some 16 MB, of 128-bit keys 100)."""
    return F.broadcast(df) if df.count() <= most_rows else df


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with as many underscores behind it as make it none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rid(docs: DataFrame, name: str = "rid") -> DataFrame:
    """docs with the column name: never 0, the same for rows of equal doc_id and text."""
    h = F.xxhash64(F.col("doc_id"), F.col("text"))
    return docs.withColumn(name, F.when(h == 0, F.lit(1)).otherwise(h).cast("bigint"))


def with_key(docs: DataFrame, name: str) -> DataFrame:
    """docs with the column name: 128 bits that stand for doc_id and text, nulls apart from empty texts."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.concat(F.lit("text "), F.col("text")))
    return docs.withColumn(name, F.unhex(F.md5(F.concat(F.length(doc_id).cast("string"), F.lit(" "), doc_id, text).cast("binary"))))


def release() -> None:
    """Give freed memory back to the system: Python workers stay on between tasks, beside the next ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow for a function of one batch; empty batches are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                if b.num_rows:
                    yield from f(b)
        finally:
            release()

    return df.mapInArrow(run, schema)


def arrow_stream(rows: pa.Table | pa.RecordBatch) -> bytes:
    """rows as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write(rows)
    return sink.getvalue().to_pybytes()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x = x * MIX1
    x = x ^ (x >> U64(27))
    x = x * MIX2
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), U64(base | 1))
    p[0] = 1
    return np.multiply.accumulate(p)


def token_hashes(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 bytes: their 64-bit hashes, starts and ends (byte offsets).

    lower: A-Z count as a-z. The hash is a polynomial over the word's bytes, scrambled with its length.
    """
    a = np.frombuffer(data, np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, U64), starts, ends
    v = a.astype(U64) + U64(1)
    if lower:
        v[(a >= 65) & (a <= 90)] += U64(32)
    v[space] = 0
    width = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a)))) if starts[0] == 0 else None
    if width is None:
        pos = np.arange(starts[0], len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
        v = v[starts[0] :]
    else:
        pos = width
    longest = int((ends - starts).max())
    pow_ = powers(0x2545F4914F6CDD1D, longest + 1)
    v *= pow_[np.minimum(pos, longest)]
    sums = np.add.reduceat(v, starts - starts[0])
    return mix64(sums ^ ((ends - starts).astype(U64) * GOLDEN)), starts, ends


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every run of k consecutive hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = mix64(out + hashes[i : i + n] + GOLDEN)
    return out


def segment_ids(lengths: np.ndarray) -> np.ndarray:
    """0 repeated lengths[0] times, 1 repeated lengths[1] times, and so on."""
    return np.repeat(np.arange(len(lengths)), lengths)
