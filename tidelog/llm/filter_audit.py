"""How filters interact: who survives which subset of them, and what each removes at each place of each order.

A document's failures of n filters (at most five) become a truth-table word of 2**n bits: bit s is set if the document
survives the subset s of filters, that is, if it fails none of them. Per part, and for all documents as for those of a
label, a tree of carry-save adders counts the words that have each bit: three words become a word of sums and one of
carries of twice the weight, so most of the work is a few bit operations on whole arrays. The counts, 2**n per part,
answer every question about orders of the filters without another look at a document.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import release, settled, with_free_names

FILTERS = "ABCDE"
#: A slice of a long text that is looked at at once; it ends at white space.
SLICE = 1 << 20
UPPER, SPACE = bytes(range(65, 91)), re.compile(rb"[\x20\x09-\x0D]")
SYMBOLS = re.compile(rb"[#$%&*|]")
#: Parts whose counts a task keeps before it passes them on.
MOST_PARTS = 10_000


def survival_words(failed: np.ndarray, n: int) -> np.ndarray:
    """The truth-table word of each bit set of failed filters."""
    subsets = np.arange(1 << n)
    table = np.array([sum(1 << int(s) for s in subsets if not s & f) for f in range(1 << n)], np.uint64).astype(np.uint32)
    return table[failed]


def positional_popcount(words: np.ndarray, bits: int = 32) -> np.ndarray:
    """How many of the words have bit 0, bit 1, … set."""
    total, weight = np.zeros(bits, np.int64), 1
    while len(words):
        carries = []
        while len(words) >= 3:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            odd = a ^ b
            carries.append((a & b) | (c & odd))
            words = np.concatenate([odd ^ c, words[3 * third :]])
        for w in words.tolist():
            total += weight * ((w >> np.arange(bits)) & 1)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return total


def measured(data: bytes) -> tuple[int, int, int, bool]:
    """Words, distinct words, letters A-Z, and whether there is a symbol; the text is looked at slice by slice."""
    n, upper, symbol, known, at = 0, 0, False, set(), 0
    while at < len(data):
        cut = SPACE.search(data, at + SLICE)
        part = data[at : cut.start()] if cut else data[at:]
        words = part.split()  # splits bytes at exactly these six characters
        n += len(words)
        known.update(words)
        upper += len(part) - len(part.translate(None, UPPER))
        symbol = symbol or SYMBOLS.search(part) is not None
        at += len(part)
    return n, len(known), upper, symbol


def text_failures(text: str) -> int:
    """Bits 0 to 3: under 50 words; distinct words under 65 %; capitals over 5 % of the code points; a symbol."""
    n, distinct, upper, symbol = measured(text.encode())
    return (n < 50) | (100 * distinct < 65 * n) << 1 | (100 * upper > 5 * len(text)) << 2 | symbol << 3


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, failed per row of docs (doc_id, text, source): bits 0 to 4 for the filters A to E.

    E fails if a smaller doc_id has the same text (SHA-256), so rows that share their text's least doc_id pass, and a
    null doc_id neither fails nor makes another fail. A null text is an empty one, a null source an empty string. Texts
    stay where they are; of a text that occurs again only digest, doc_id and flags are shuffled, and the join's hot
    digests can be split.
    """
    df = with_free_names(docs, ["doc_id", "text", "source"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                texts = [t or "" for t in b.column("text").to_pylist()]
                digests = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source").fill_null(""), pa.array([text_failures(t) for t in texts], pa.int32()), digests], names=["doc_id", "part", "failed", "digest"])
        finally:
            release()

    own = settled(df.withColumn("source", F.col("source").cast("string")).mapInArrow(look, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, part string, failed int, digest binary"), "failures")
    firsts = settled(own.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("digest", "first"), "firsts")
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return own.join(firsts, "digest", "left").select("doc_id", "part", F.col("failed").bitwiseOR(F.when(again, 16).otherwise(0)).alias("failed"))


def with_labels(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """failed with good (quality 1) and toxic (toxic 1); documents without labels have neither, of repeated labels one is enough."""
    is_one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    known = settled(with_free_names(labels, ["doc_id", "quality", "toxic"]).groupBy("doc_id").agg(is_one("quality"), is_one("toxic")).filter("quality = 1 or toxic = 1"), "audit-labels")
    return failed.join(known, "doc_id", "left").select("part", "failed", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).na.fill(False, ["good", "toxic"])


def subset_survivors(failed: DataFrame, n: int = 5, labels: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """part, subset, n_all and a column per label: how many rows (part, failed, labels as booleans) survive each subset.

    Tasks count their own rows part by part and pass on sums; no rows give no rows.
    """
    columns = ["part", "subset", "n_all", *labels]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def passed_on() -> pa.RecordBatch:
            found = np.stack(list(sums.values()))
            out = pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(sums), object), 1 << n), pa.string()), pa.array(np.tile(np.arange(1 << n, dtype=np.int32), len(sums))), *[pa.array(found[:, i].ravel()) for i in range(1 + len(labels))]], names=columns)
            sums.clear()
            return out

        for b in batches:
            words = survival_words(b.column("failed").to_numpy(), n)
            marks = [b.column(x).to_numpy(zero_copy_only=False) for x in labels]
            parts = b.column("part").dictionary_encode()
            index, names = parts.indices.to_numpy(), parts.dictionary.to_pylist()
            order = np.argsort(index, kind="stable")
            for name, at in zip(names, np.split(order, np.cumsum(np.bincount(index, minlength=len(names)))[:-1]), strict=True):
                own = np.stack([positional_popcount(w, 1 << n) for w in (words[at], *[words[at[m[at]]] for m in marks])])
                sums[name] = sums[name] + own if name in sums else own
            if len(sums) >= MOST_PARTS:
                yield passed_on()
        if sums:
            yield passed_on()

    counts = failed.select("part", "failed", *labels).mapInArrow(count, "part string, subset int, " + ", ".join(f"{c} bigint" for c in columns[2:]))
    return counts.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in columns[2:]])


def order_report(survivors: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step: what the step's filter does there, from subset_survivors' counts.

    kept, removed, redundant (fail it, removed earlier), unique_fails (fail it alone), good_lost and toxic_lost (labelled
    among the removed), and shapley, the filter's removals summed over all orders.
    """
    n, full = len(filters), (1 << len(filters)) - 1
    orders = list(permutations(range(n)))
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    own = np.array([[1 << x for x in o] for o in orders])
    after = np.bitwise_or.accumulate(own, axis=1)
    before = after ^ own
    order_names = np.repeat(np.array(["".join(filters[x] for x in o) for o in orders], object), n)
    steps = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                counts = np.zeros((3, full + 1), np.int64)
                for s in row["counts"]:
                    counts[:, s["subset"]] = s["n_all"], s["good"], s["toxic"]
                every, good, toxic = counts
                removed = every[before] - every[after]
                weight = [math.factorial(k) * math.factorial(n - 1 - k) for k in range(n)]
                shares = np.array([sum(weight[s.bit_count()] * int(every[s] - every[s | 1 << x]) for s in range(full + 1) if not s >> x & 1) for x in range(n)])
                columns = [every[after], removed, every[0] - every[own] - removed, every[full ^ own] - every[full], good[before] - good[after], toxic[before] - toxic[after], shares[np.log2(own).astype(int)]]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(steps), pa.string()), pa.array(order_names, pa.string()), pa.array(steps), *[pa.array(c.ravel()) for c in columns]], names=["part", *names])

    whole = survivors.groupBy("part").agg(F.collect_list(F.struct("subset", "n_all", "good", "toxic")).alias("counts"))
    return whole.mapInArrow(expand, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in names[2:]))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """order_report of the five filters over docs (doc_id, text, source), with labels (doc_id, quality, toxic).

    Every row of docs is a document of its own; other columns are ignored; an empty table has no parts and gives no rows.
    """
    return order_report(subset_survivors(with_labels(failures(docs), labels)))
