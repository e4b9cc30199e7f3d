"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, kept in text order, hashed as tuples.

Every k-mer of a text, numbered by its occurrence, is hashed once; the hash's top bits choose one of `bins` components
and the rest ranks it there (one hash partitioned over the components in place of one hash per component). Each
component keeps its `picks` minimal k-mers, puts them in text order and hashes that tuple, so that moved or edited
stretches change it where a plain MinHash would not notice.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import GOLDEN, U64, map_batches, mix64, with_free_names

K, BIN_BITS, PICKS = 8, 7, 2
LOWEST = -(1 << 63)


def kmer_hashes(text: str, k: int = K) -> np.ndarray:
    """64-bit hashes of the k-mers (code points) in text order; a shorter text is one k-mer, an empty one has none."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    if not len(c):
        return c
    k = min(k, len(c))
    h = np.zeros(len(c) - k + 1, U64)
    for i in range(k):
        h *= U64(0x9E3779B97F4A7C15)
        h += c[i : i + len(h)]
    return mix64(h + U64(k))


def fingerprint(text: str, k: int = K, bin_bits: int = BIN_BITS, picks: int = PICKS) -> np.ndarray:
    """2**bin_bits components of 16 bits; 0 marks a component without k-mers."""
    h = kmer_hashes(text, k)
    out = np.zeros(1 << bin_bits, np.uint16)
    n = len(h)
    if not n:
        return out
    low = U64(20)  # the same for every text, or texts of different sizes would have no k-mer in common
    if n <= 1 << 20:  # the place fits beside the k-mer
        s = np.sort(((h >> low) << low) | np.arange(n, dtype=U64))
        kmer, pos = s >> low, s & ((U64(1) << low) - U64(1))
    else:
        kmer = h >> low
        pos = np.argsort(kmer, kind="stable")
        kmer = kmer[pos]
    first = np.append(True, kmer[1:] != kmer[:-1])
    index = np.arange(n)
    nth = index - np.maximum.accumulate(np.where(first, index, 0))
    rank = mix64(kmer + nth.astype(U64) * GOLDEN)
    shift = U64(64 - bin_bits)
    value = rank & ((U64(1) << shift) - U64(1))
    enough = 16 << bin_bits
    keep = np.arange(n)
    if n > 2 * enough:  # the minima lie among the small values; if a component lacks any, look at all
        some = np.flatnonzero(value < U64(int((1 << int(shift)) * (enough / n))))
        if len(some) and np.bincount((rank[some] >> shift).astype(np.int64), minlength=1 << bin_bits).min() >= picks:
            keep = some
    keep = keep[np.argsort(rank[keep], kind="stable")]
    bins = (rank[keep] >> shift).astype(np.int64)
    starts = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    place = np.arange(len(keep)) - np.repeat(starts, np.diff(np.append(starts, len(keep))))
    keep, bins = keep[place < picks], bins[place < picks]
    order = np.lexsort((pos[keep], bins))
    keep, bins = keep[order], bins[order]
    tuples = np.zeros(1 << bin_bits, U64)
    starts = np.append(np.flatnonzero(np.append(True, bins[1:] != bins[:-1])), len(bins))
    for j in range(picks):
        at = starts[:-1] + j
        at = at[at < starts[1:]]
        tuples[bins[at]] = mix64(tuples[bins[at]] * GOLDEN + kmer[keep[at]] + U64(j + 1))
    filled = np.unique(bins)
    out[filled] = (tuples[filled] % U64(65535)).astype(np.uint16) + np.uint16(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components among those that either has; 1 for two texts without k-mers."""
    either = np.count_nonzero((a > 0) | (b > 0))
    return float(np.count_nonzero((a == b) & (a > 0)) / either) if either else 1.0


def to_text(fp: np.ndarray) -> str:
    return fp.astype(">u2").tobytes().hex()


def leading(texts: list[str | None]) -> np.ndarray:
    """The first seven UTF-8 bytes as a number, turned so that greater texts have smaller ones."""
    return np.array([(1 << 56) - 1 - int.from_bytes((t or "")[:7].encode("utf-8", "surrogatepass")[:7].ljust(7, b"\0"), "big") for t in texts], np.int64)


def quantiles(df: DataFrame, column: str, n: int) -> list[int]:
    """About n - 1 values that cut the column into equal parts; a frequent value occurs several times."""
    return [int(x) for x in df.approxQuantile(column, [i / n for i in range(1, n)], 0.1 / n)] if n > 1 else []


class Stretches:
    """Numbers ranges of (key, lead) in ascending order. `cuts` holds, by key, the leads at which a frequent key is cut."""

    def __init__(self, bounds: list[int], cuts: dict[int, list[int]]):
        self.bounds, self.cuts = np.array(sorted(set(bounds)), np.int64), {k: np.array(v, np.int64) for k, v in cuts.items()}
        sizes = np.array([1 + (len(self.cuts[k]) + 1 if k in self.cuts else 0) for k in self.bounds.tolist()], np.int64)
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int64)  # a stretch of smaller keys, then those of the bound itself

    def of(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, leads (0 for a key that isn't cut) and stretches of a batch."""
        keys = b.column("key").to_numpy()
        out, leads = self.first[np.searchsorted(self.bounds, keys)], np.zeros(len(keys), np.int64)
        for k, cuts in self.cuts.items():
            own = np.flatnonzero(keys == k)
            if len(own):
                leads[own] = leading(b.column("text").take(pa.array(own)).to_pylist())
                out[own] += 1 + np.searchsorted(cuts, leads[own])
        return keys, leads, out


def with_neighbours(docs: DataFrame) -> DataFrame:
    """docs' doc_id and text, with stretch, key and guest: each stretch holds a range of documents and, as guest, the document after its last.

    The order is descending doc_id, equal ids by text; null ids come last, and the first document follows the last. An
    id with more rows than a stretch (null ids, say) is cut by its texts' first bytes; texts that share an id and seven
    bytes stay together. Only the bounds of the stretches, some eight per shuffle partition, reach the driver.
    """
    df = with_free_names(docs, ["doc_id", "text"]).withColumn("key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)))
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [min(max(x, LOWEST), -(LOWEST + 1)) for x in quantiles(df, "key", n)]

    def label(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(leading(b.column("text").to_pylist()))], names=["key", "lead"])

    leads = lambda of: map_batches(of.select("key", "text"), label, "key bigint, lead bigint")
    often = {k: m for k, m in Counter(bounds).items() if m > 1}
    stretches = Stretches(bounds, {k: sorted(set(quantiles(leads(df.filter(F.col("key") == k)), "lead", m + 1))) for k, m in often.items()})

    def place(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in stretches.of(b)], names=["key", "lead", "stretch"])

    tops = {r["stretch"]: (r["top"]["key"], r["top"]["lead"]) for r in map_batches(df.select("key", *(["text"] if often else [])), place, "key bigint, lead bigint, stretch bigint").groupBy("stretch").agg(F.max(F.struct("key", "lead")).alias("top")).collect()}
    used = sorted(tops)
    host = {tops[s]: used[(i + 1) % len(used)] for i, s in enumerate(used)}  # a stretch's first document is the guest of the one above

    def spread(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, lead, own = stretches.of(b)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(np.zeros(len(keys), bool))], names=[*b.schema.names, "stretch", "guest"])
        found = [(i, host[x]) for i, x in enumerate(zip(keys.tolist(), lead.tolist(), strict=True)) if x in host]
        if found:
            yield pa.RecordBatch.from_arrays([*b.take(pa.array([i for i, _ in found])).columns, pa.array([s for _, s in found]), pa.array([True] * len(found))], names=[*b.schema.names, "stretch", "guest"])

    return map_batches(df, spread, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, text string, key bigint, stretch bigint, guest boolean")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text's sha256, fingerprint, edited_fingerprint, near_edited, near_next; a row per row of docs.

    The edited text has its last n_chars // 2 code points replaced by as many first ones (or all) of the next document
    in descending doc_id. A null text is empty; other columns are ignored; a lone document is its own next one.
    """
    df = with_neighbours(docs)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(n, "stretch").sortWithinPartitions("stretch", "guest", F.col("key").desc(), F.coalesce("text", F.lit("")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # stretch, doc_id, text, fingerprint of the document that waits for its next one
        for b in batches:
            out, ids = [], []
            for i, (text, stretch, guest) in enumerate(zip(b.column("text").to_pylist(), b.column("stretch").to_pylist(), b.column("guest").to_pylist(), strict=True)):
                text = text or ""
                if guest and last is None:
                    continue  # a guest's own equals in doc_id follow it
                own = last[3] if last and last[2] == text else fingerprint(text)
                if last is not None:
                    _, doc, before, fp = last
                    half = len(before) // 2
                    edited = before[: len(before) - half] + text[:half]
                    efp = fp if edited == before else fingerprint(edited)
                    ids.append(doc)
                    out.append((len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(fp), to_text(efp), likeness(fp, efp), likeness(fp, own)))
                last = None if guest else (stretch, b.column("doc_id")[i], text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], b.column("doc_id").type), *[pa.array(list(c)) for c in zip(*out, strict=True)]], names=names)

    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
