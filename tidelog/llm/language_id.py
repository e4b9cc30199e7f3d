"""Language identification with interpolated Kneser-Ney character models.

A text is a stream of letters, as UTF-16 units, and blanks; four of them make a 4-gram, a 64-bit number that stands for
just that 4-gram. Spark sums the 4-grams of all training texts per language; the orders below follow from them, as
Kneser-Ney counts there how many different symbols an n-gram follows. Joins and sums make the model table: interpolated
log-probabilities per n-gram and log-weights per context. It grows with the n-grams of the corpus. Up to a checked size
tasks hold it as arrays sorted by hash, with a directory by the hash's leading bits; beyond, texts' n-grams are joined
with it.

Training texts are dealt to two halves by their content, each half has its own counts, and every text is scored by the
half that it is not in. So no text is judged by what it taught itself: its language is that of the lowest cross-entropy
per symbol, and it is rejected if that lies beyond what training texts of its language and length show. One part of the
training texts sets these ceilings, the rest says how far above them a rejection must lie for its rate to be kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import GOLDEN, U64, map_batches, release, settled, with_free_names

UNKNOWN = "und"
ORDER = 4
BLANK = 32
#: Symbols worked on at a time; bounds memory, not texts.
CHUNK = 1 << 17
#: The quantile of a length class of at least LEAST training texts that rejection starts from; up to a twentieth may be no language.
HIGH, LEAST = 0.95, 100
#: Share of texts like the training texts that may be rejected at most; what is no language among these included.
RATE = 0.1
#: Bytes up to which tasks get the whole model.
MOST_MODEL = 64 << 20
ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@cache
def letters() -> np.ndarray:
    """For every UTF-16 unit: its lower case if it is a letter, itself if it is half a letter or the mark between texts (0), else a blank."""
    lower = [ord(c) if "\ud800" <= (c := chr(u)) <= "\udfff" else ord(c.lower()[0]) if unicodedata.category(c)[0] == "L" else BLANK for u in range(1 << 16)]
    return np.array([0, *[u if u < 1 << 16 else BLANK for u in lower[1:]]], np.uint16)


def symbols(text: str) -> np.ndarray:
    """Letters and blanks of a text without 0; every run of other characters is one blank."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    if len(units) != len(text):
        text = ASTRAL.sub(lambda m: m[0] if unicodedata.category(m[0])[0] == "L" else " ", text)
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    s = letters()[units]
    keep = s != BLANK
    keep[1:] |= keep[:-1].copy()
    return s[keep]


def stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the texts end to end, each led by ORDER-1 zeros; where each text begins, and how many symbols it has (0 if it has no letter)."""
    mark, parts, short = "\0" * (ORDER - 1), [], []

    def flush() -> None:
        if short:
            parts.append(symbols(mark + mark.join(short)))
            short.clear()

    for t in texts:
        t = (t or "").replace("\0", " ")
        if len(t) <= CHUNK:
            short.append(t)
            continue
        flush()
        parts.append(np.zeros(ORDER - 1, np.uint16))
        last = 0
        for i in range(0, len(t), CHUNK):
            s = symbols("\0" + t[i : i + CHUNK])[1:]
            parts.append(s[int(last == s[0] == BLANK) :])
            last = s[-1]
    flush()
    s = np.concatenate(parts)
    zeros = np.flatnonzero(s == 0)
    begins = zeros[ORDER - 2 :: ORDER - 1] + 1
    sizes = np.append(zeros[ORDER - 1 :: ORDER - 1], len(s)) - begins
    return s, begins, np.where((sizes == 1) & (s[np.minimum(begins, len(s) - 1)] == BLANK), 0, sizes)


def grams(s: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each position from ORDER-1 on."""
    two = (s[:-1].astype(np.uint32) << np.uint32(16)) | s[1:]
    return (two[:-2].astype(U64) << U64(32)) | two[2:]


def slices(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of positions from ORDER-1 to n."""
    for a in range(ORDER - 1, n, CHUNK):
        yield a, min(a + CHUNK, n)


def split(items: list[int], sizes: list[int], most: int = CHUNK) -> Iterator[list[int]]:
    part, total = [], 0
    for i, n in zip(items, sizes, strict=True):
        part.append(i)
        total += n
        if total >= most:
            yield part
            part, total = [], 0
    if part:
        yield part


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys))) if counts is None else np.add.reduceat(counts, starts) if len(starts) else counts


def count_ngrams(docs: DataFrame, langs: list[str]) -> DataFrame:
    """gram and c0 .. : how often each 4-gram occurs in docs (lang, fold, text), by fold * len(langs) + language."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, rows = b.column("text").to_pylist(), {}
        for i, at in enumerate(zip(b.column("fold").to_pylist(), b.column("lang").to_pylist(), strict=True)):
            rows.setdefault(at, []).append(i)
        for (fold, lang), own in rows.items():
            found = []
            for part in split(own, [len(texts[i] or "") for i in own]):
                s, _, sizes = stream([texts[i] for i in part])
                if sizes.any():
                    found += [summed(grams(s[a - ORDER + 1 : e])[s[a:e] != 0]) for a, e in slices(len(s))]
            if found:
                keys, counts = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), fold * len(langs) + langs.index(lang), np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["of", "gram", "n"])

    parts = map_batches(with_free_names(docs, ["lang", "fold", "text"]), run, "of int, gram bigint, n bigint")
    return parts.groupBy("gram").agg(*[F.coalesce(F.sum(F.when(F.col("of") == j, F.col("n"))), F.lit(0)).alias(f"c{j}") for j in range(2 * len(langs))])


def suffix(gram: Column, n: int) -> Column:
    """The n-gram without its first symbol."""
    return gram.bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))


def context(gram: Column) -> Column:
    """The n-gram without its last symbol."""
    return F.shiftrightunsigned(gram, 16)


def model_table(counts: DataFrame, langs: list[str]) -> tuple[list[str], DataFrame, list[float]] | None:
    """The languages that any text taught; kind, gram, v (an array, by fold and language) with log-probabilities of n-grams (kind n) and log-weights of contexts of n-grams (kind 10 + n); log-probabilities of an unseen symbol.

    Raw counts at the top, below how many symbols an n-gram follows; one discount for each order and language. A half
    that has taught a language nothing borrows the other half's counts.
    """
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in counts.columns[1:]]).first()
    half = len(langs)
    taught = [j for j in range(half) if total[j] or total[half + j]]
    if not taught:
        return None
    pick = [f * half + j if total[f * half + j] else (1 - f) * half + j for f in (0, 1) for j in taught]
    m = range(len(pick))
    by_order = {ORDER: counts.select("gram", *[F.col(f"c{j}").alias(f"c{i}") for i, j in enumerate(pick)])}
    for n in range(ORDER, 1, -1):
        below = by_order[n].groupBy(suffix(F.col("gram"), n).alias("gram")).agg(*[F.sum((F.col(f"c{i}") > 0).cast("bigint")).alias(f"c{i}") for i in m])
        by_order[n - 1] = settled(below, "orders")

    facts = {n: t.agg(F.count("*"), *[F.coalesce(F.sum(x), F.lit(0)) for i in m for c in [F.col(f"c{i}")] for x in ((c == 1).cast("bigint"), (c == 2).cast("bigint"), c, (c > 0).cast("bigint"))]).first() for n, t in by_order.items()}
    discount = {n: [r[4 * i + 1] / (r[4 * i + 1] + 2 * r[4 * i + 2]) if r[4 * i + 1] else 0.5 for i in m] for n, r in facts.items()}
    even = 1 / (facts[1][0] + 1)  # one place is kept for symbols never seen
    weight = [discount[1][i] * facts[1][4 * i + 4] / facts[1][4 * i + 3] for i in m]
    array = lambda kind, gram, values: (F.lit(kind).alias("kind"), gram.alias("gram"), F.array(*[F.log(v).cast("float") for v in values]).alias("v"))
    over = lambda n, i: F.greatest(F.col(f"c{i}") - F.lit(discount[n][i]), F.lit(0.0))
    p = by_order[1].select("gram", *[(over(1, i) / facts[1][4 * i + 3] + weight[i] * even).alias(f"p{i}") for i in m])
    tables = [p.select(*array(1, F.col("gram"), [F.col(f"p{i}") for i in m]))]
    for n in range(2, ORDER + 1):
        own = by_order[n].withColumn("context", context(F.col("gram"))).withColumn("suffix", suffix(F.col("gram"), n))
        of = own.groupBy("context").agg(*[F.sum(f"c{i}").alias(f"s{i}") for i in m], *[F.sum((F.col(f"c{i}") > 0).cast("bigint")).alias(f"k{i}") for i in m])
        of = settled(of.select("context", *[f"s{i}" for i in m], *[F.when(F.col(f"s{i}") > 0, F.lit(discount[n][i]) * F.col(f"k{i}") / F.col(f"s{i}")).otherwise(1.0).alias(f"w{i}") for i in m]), "contexts")
        low = p.select(F.col("gram").alias("suffix"), *[F.col(f"p{i}").alias(f"low{i}") for i in m])
        p = own.join(of, "context").join(low, "suffix").select("gram", *[(over(n, i) / F.greatest(F.col(f"s{i}"), F.lit(1)) + F.col(f"w{i}") * F.col(f"low{i}")).alias(f"p{i}") for i in m])
        p = settled(p, "orders")
        tables += [p.select(*array(n, F.col("gram"), [F.col(f"p{i}") for i in m])), of.select(*array(10 + n, F.col("context"), [F.col(f"w{i}") for i in m]))]
    return [langs[j] for j in taught], settled(reduce(DataFrame.unionByName, tables), "model"), [float(np.log(w * even)) for w in weight]


@dataclass
class Sorted:
    """N-grams sorted by hash with a column of values each; the hash is one to one."""

    hashes: np.ndarray
    values: np.ndarray
    first: np.ndarray
    shift: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Sorted:
        h = keys.view(U64) * GOLDEN
        order = np.argsort(h)
        h, bits = h[order], max(4, 1 + int(len(h)).bit_length())
        return cls(h, np.ascontiguousarray(values[:, order]), np.searchsorted(h, np.arange(1 << bits, dtype=U64) << U64(64 - bits)).astype(np.int32), 64 - bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if there is none."""
        h = keys * GOLDEN
        at = self.first[(h >> U64(self.shift)).astype(np.int64)]
        got = self.hashes[np.minimum(at, len(self.hashes) - 1)]
        out = np.where((at < len(self.hashes)) & (got == h), at, np.int32(-1))
        left = np.flatnonzero((got < h) & (at < len(self.hashes) - 1))
        while len(left):
            at[left] += 1
            got = self.hashes[at[left]]
            hit = got == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[(got < h[left]) & (at[left] < len(self.hashes) - 1)]
        return out


@dataclass
class Model:
    """For each half: n-grams by order, contexts by order, log-probabilities of an unseen symbol; a column per language."""

    langs: list[str]
    known: list[dict[int, Sorted]]
    unseen: list[np.ndarray]

    @classmethod
    def of(cls, table: pa.Table, langs: list[str], unseen: list[float]) -> Model:
        kind, keys = table.column("kind").to_numpy(), table.column("gram").to_numpy()
        values = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(keys), 2 * len(langs)).T
        cut = [slice(0, len(langs)), slice(len(langs), None)]
        return cls(langs, [{int(k): Sorted.of(keys[kind == k], values[c][:, kind == k]) for k in np.unique(kind)} for c in cut], [np.array(unseen[c], np.float32) for c in cut])

    def logs(self, half: int, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of n-grams, a row per language; one that is not known has its context's weight and the lower order."""
        if n == 0:
            return np.repeat(self.unseen[half][:, None], len(keys), 1)
        own = self.known[half][n]
        at = own.find(keys)
        out = np.stack([np.take(v, at) for v in own.values])
        if len(miss := np.flatnonzero(at < 0)):
            out[:, miss] = self.logs(half, keys[miss] & U64((1 << 16 * (n - 1)) - 1), n - 1)
            if n > 1:
                weights = self.known[half][10 + n]
                of = weights.find(keys[miss] >> U64(16))
                out[:, miss[of >= 0]] += weights.values[:, of[of >= 0]]
        return out

    def sums(self, half: int, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Each text's log-probability in each language, and its number of symbols."""
        s, begins, sizes = stream(texts)
        out = np.zeros((len(texts), len(self.langs)))
        if not sizes.any():
            return out, sizes
        for a, e in slices(len(s)):
            logs = self.logs(half, grams(s[a - ORDER + 1 : e]))
            logs[:, s[a:e] == 0] = 0
            i, j = np.searchsorted(begins, a, "right") - 1, np.searchsorted(begins, e, "left")
            for k, row in enumerate(logs):
                out[i:j, k] += np.add.reduceat(row, np.maximum(begins[i:j] - a, 0), dtype=np.float64)
        return out, sizes


def rated(sums: np.ndarray, sizes: np.ndarray, langs: list[str]) -> list[list]:
    """lang_best, n_symbols, entropy, margin per text; nulls where it has no symbol."""
    e = -sums / np.maximum(sizes, 1)[:, None]
    low = np.sort(e, axis=1)
    best, margin, some = e.argmin(axis=1), low[:, min(1, len(langs) - 1)] - low[:, 0], sizes > 0
    return [[langs[j] if x else None for j, x in zip(best, some, strict=True)], sizes.tolist(), *[[v if x else None for v, x in zip(of.tolist(), some, strict=True)] for of in (low[:, 0], margin)]]


RATED = "lang_best string, n_symbols bigint, entropy double, margin double"


def score_texts(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep and RATED of docs (text, fold) by the whole model in every task."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m, texts, folds = model.value, b.column("text").to_pylist(), b.column("fold").to_numpy()
        sums, sizes = np.zeros((len(texts), len(m.langs))), np.zeros(len(texts), np.int64)
        for fold in (0, 1):
            own = np.flatnonzero(folds == fold).tolist()
            for part in split(own, [len(texts[i] or "") for i in own]):
                sums[part], sizes[part] = m.sums(1 - fold, [texts[i] for i in part])
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *[pa.array(x, t) for x, t in zip(rated(sums, sizes, m.langs), (pa.string(), pa.int64(), pa.float64(), pa.float64()), strict=True)]], names=[*keep, *(x.split()[0] for x in RATED.split(", "))])

    df = with_free_names(docs, [*keep, "text", "fold"])
    return map_batches(df, run, ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", " + RATED)


def score_by_joins(docs: DataFrame, table: DataFrame, langs: list[str], unseen: list[float], keep: list[str]) -> DataFrame:
    """What score_texts returns, by joins of the texts' 4-grams with the model table, however large that is."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t, fold, text_id in zip(b.column("text").to_pylist(), b.column("fold").to_pylist(), b.column("text_id").to_pylist(), strict=True):
            s, _, sizes = stream([t])
            if sizes[0]:
                found = [summed(grams(s[a - ORDER + 1 : e])[s[a:e] != 0]) for a, e in slices(len(s))]
                keys, counts = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), text_id)), pa.array(np.full(len(keys), fold, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["text_id", "fold", "gram", "m"])

    named = docs.withColumn("text_id", F.xxhash64("text"))
    texts = named.select("text_id", "text", "fold").dropDuplicates(["text_id"])
    rows = settled(map_batches(texts, run, "text_id bigint, fold int, gram bigint, m bigint"), "grams")
    seen, own = rows.select("gram").distinct(), F.col("gram")
    for n in range(ORDER, 0, -1):
        seen = seen.withColumn("at", own)
        seen = seen.join(table.filter(F.col("kind") == n).select(F.col("gram").alias("at"), F.col("v").alias(f"p{n}")), "at", "left")
        seen = seen.withColumn("at", context(own))
        if n > 1:
            seen = seen.join(table.filter(F.col("kind") == 10 + n).select(F.col("gram").alias("at"), F.col("v").alias(f"w{n}")), "at", "left")
        own = suffix(own, n) if n > 1 else own
    p = F.array(*map(F.lit, unseen)).cast("array<float>")
    for n in range(1, ORDER + 1):
        low = p if n == 1 else F.when(F.col(f"w{n}").isNull(), p).otherwise(F.zip_with(p, f"w{n}", lambda x, y: x + y))
        p = F.coalesce(f"p{n}", low)
    joined = rows.join(seen.select("gram", p.alias("p")), "gram")
    k = len(langs)
    sums = joined.groupBy("text_id").agg(F.sum("m").alias("n_symbols"), *[F.sum(F.col("m") * F.col("p")[(1 - F.col("fold")) * k + j]).alias(f"s{j}") for j in range(k)])

    def rate(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = rated(np.column_stack([b.column(f"s{j}").to_numpy() for j in range(k)]), b.column("n_symbols").to_numpy(), langs)
        yield pa.RecordBatch.from_arrays([b.column("text_id"), *[pa.array(x, t) for x, t in zip(found, (pa.string(), pa.int64(), pa.float64(), pa.float64()), strict=True)]], names=["text_id", *(x.split()[0] for x in RATED.split(", "))])

    found = map_batches(sums, rate, "text_id bigint, " + RATED)
    return named.join(found, "text_id", "left").select(*keep, "lang_best", F.coalesce("n_symbols", F.lit(0)).alias("n_symbols"), "entropy", "margin")


def ceilings(scored: DataFrame, langs: list[str]) -> DataFrame:
    """lang_best, size, ceiling: the quantile HIGH of the entropies of the training texts with `sets` of that language and length class.

    A class of under LEAST training texts takes the quantile of its length in all languages, or else that of all texts.
    """
    found = scored.filter("teaches and sets and entropy is not null").cube("lang_best", "size").agg(F.count("*").alias("n"), F.percentile_approx("entropy", F.lit(HIGH), F.lit(10_000)).alias("ceiling")).collect()
    known = {(r["lang_best"], r["size"]): r["ceiling"] for r in found if r["n"] >= LEAST or r["lang_best"] is None and r["size"] is None}
    rows = []
    for lang in langs:
        for size in range(48):
            own = next((known[c] for c in ((lang, size), (None, size), (None, None)) if known.get(c) is not None), None)
            rows.append((lang, size, own))
    return scored.sparkSession.createDataFrame(rows, "lang_best string, size int, ceiling double")


def rooms(measured: DataFrame, langs: list[str], slack: float, rate: float) -> DataFrame:
    """lang_best, room: an excess over the ceiling beyond which at most `rate` of texts like the training texts lie; slack at least.

    It is the excess of rank (n + 1) * (1 - rate) among the n training texts without `sets` that are taken for the
    language: a further text of their kind exceeds it with a probability of at most rate, whatever their distribution.
    Languages of under LEAST such texts share the room of all texts; too few texts in all (n < 1 / rate - 1) give none a
    limit.
    """
    shares = [1 - rate * i / 40 for i in range(39, -1, -1)]
    found = measured.filter("teaches and not sets and excess is not null").rollup("lang_best").agg(F.count("*").alias("n"), F.percentile_approx("excess", shares, 10_000).alias("at")).collect()
    room = {None: inf}
    for r in found:
        rank, n = ceil((r["n"] + 1) * (1 - rate)), r["n"]
        if r["lang_best"] is None or n >= LEAST:  # quantiles are exact to a 10,000th of the ranks
            room[r["lang_best"]] = inf if rank > n else max(slack, next((v for p, v in zip(shares, r["at"], strict=True) if p * n >= rank + n / 10_000), r["at"][-1]))
    return measured.sparkSession.createDataFrame([(lang, room.get(lang, room[None])) for lang in langs], "lang_best string, room double")


def identify(docs: DataFrame, teaches: Column | None = None, slack: float = 1.0, key: str = "doc_id", most_model: int = MOST_MODEL, rate: float = RATE) -> DataFrame:
    """doc_id (or the column key), lang_pred, score, rejected, n_symbols, entropy; a row per row of docs (doc_id, text, lang).

    teaches: condition over docs' columns that picks the rows to learn from (default all); rows with a null lang or
    without a letter teach nothing. A text that is null, empty or without a letter is `und` with score 0 and rejected.
    score: share of the best language against the next, from the margin over the text's symbols. rejected: the text's
    cross-entropy, by the half of the training texts that it is not in, lies more than slack nats (of n symbols,
    1 + 4 / sqrt(n) times as much) above the ceiling of its language and length class in powers of two (ceilings), and
    more than rate allows: of texts with letters that are like the training texts taken for a language at most that
    share is rejected (rooms), slack only makes it less. Copies count as often as they occur. Ties go to the language first in order. Without any training text all are `und` and rejected. Other columns are
    ignored. most_model: bytes of a model that every task may hold; a larger one is joined.
    """
    df = docs.withColumn("teaches", (F.lit(True) if teaches is None else F.coalesce(teaches, F.lit(False))) & F.col("lang").isNotNull())
    df = with_free_names(df, [key, "text", "lang", "teaches"]).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))  # copies share a fold
    df = df.withColumn("sets", F.pmod(F.shiftright(F.xxhash64("text"), 1), F.lit(2)) == 0)
    taught = df.filter("teaches").select(F.col("lang").cast("string").alias("lang"), "fold", "text")
    langs = sorted(r["lang"] for r in taught.select("lang").distinct().collect())
    made = model_table(settled(count_ngrams(taught, langs), "ngrams"), langs) if langs else None
    if made is None:
        none = F.lit(None).cast("double")
        return df.select(key, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(0).cast("bigint").alias("n_symbols"), none.alias("entropy"))
    langs, table, unseen = made
    if table.count() * (12 + 8 * len(langs)) <= most_model:
        scored = score_texts(df, Model.of(table.toArrow(), langs, unseen), [key, "teaches", "sets"])
        release()
    else:
        scored = score_by_joins(df, table, langs, unseen, [key, "teaches", "sets"])
    scored = settled(scored.withColumn("size", F.floor(F.log2(F.greatest(F.col("n_symbols"), F.lit(1)))).cast("int")), "languages")
    unit = 1 + 4 / F.sqrt(F.greatest(F.col("n_symbols"), F.lit(1)))
    scored = scored.join(F.broadcast(ceilings(scored, langs)), ["lang_best", "size"], "left").withColumn("excess", (F.col("entropy") - F.col("ceiling")) / unit)
    scored = scored.join(F.broadcast(rooms(scored, langs, slack, rate)), "lang_best", "left")
    return scored.select(
        key,
        F.coalesce("lang_best", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(F.round(1 / (1 + F.exp(-F.col("margin") * F.least(F.col("n_symbols"), F.lit(50)))), 9), F.lit(0.0)).alias("score"),
        (F.col("entropy").isNull() | F.coalesce(F.col("excess") > F.col("room"), F.lit(False))).alias("rejected"),
        "n_symbols",
        "entropy",
    )
