"""Quality rules whose cutoffs are chosen under risk control.

Each rule rejects texts whose rate exceeds a cutoff. A quarter of the labelled documents, by a hash of their ids,
proposes: per stratum and rule the cutoff of most gain (bad documents rejected, less good ones) whose share of good ones
is within the allowed risk, the mildest of equals. The rules that gain, those with fewest good documents first, are a
fixed sequence of ever stricter rule sets. The other three quarters test it: a set is certified while the exact binomial
upper bound of all its false rejections together stays within the risk, and the first set that isn't ends the sequence,
so that all of a stratum's tests run at one level (fixed-sequence testing). Strata with a sequence share the error level
by Bonferroni. A stratum with too few good documents gets no rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import fold, map_batches, settled, token_hashes, windows, with_free_names

#: The characters that count as symbols, and the limits of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
#: Rate of each rule; all lie in 0..1 after clipping.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
}
#: Cutoffs tried, mildest first.
CUTOFFS = [0.9 - 0.02 * i for i in range(45)]

SYMBOL_BYTE, UPPER_BYTE = np.zeros(256, bool), np.zeros(256, bool)
SYMBOL_BYTE[list(SYMBOLS)], UPPER_BYTE[65:91] = True, True


def text_counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; null counts as empty. n_lines: lines with a word; n_marks: ! and ?; n_upper: A-Z."""
    data = (text or "").encode()
    hashes, starts, ends = token_hashes(data)
    if not len(hashes):
        return (0,) * len(COUNTS)
    a = np.frombuffer(data, np.uint8)
    spaces = np.count_nonzero((a == 32) | ((a >= 9) & (a <= 13)))
    chars = len(text) - spaces
    lines = [x for x in data.split(b"\n") if x.strip()]
    w, repeated = windows(hashes, WINDOW), 0
    if len(w):
        order = np.argsort(w)
        same = w[order][1:] == w[order][:-1]
        if same.any():
            twice = np.zeros(len(w), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            cover = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(cover, np.flatnonzero(twice), 1)
            np.add.at(cover, np.flatnonzero(twice) + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(cover) > 0))
    marks = data.count(b"!") + data.count(b"?")
    return len(hashes), chars, int(SYMBOL_BYTE[a].sum()), len(lines) - len(set(lines)), repeated, len(lines), int(UPPER_BYTE[a].sum()), marks


def count_texts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep and COUNTS, a row per row of docs."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = np.array([text_counts(t) for t in b.column("text").to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *[pa.array(counts[:, i]) for i in range(len(COUNTS))]], names=[*keep, *COUNTS])

    df = with_free_names(docs, [*keep, "text"])
    return map_batches(df, run, ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} bigint" for c in COUNTS)]))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i]) + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs - logs.max()).sum() * math.exp(logs.max())))


def certified_cutoff(good_hit: list[int], bad_hit: list[int], good: int, risk: float, level: float) -> float | None:
    """The certified cutoff of most gain; good_hit, bad_hit: documents rejected at each of CUTOFFS. At level 1 the share of good ones alone decides."""
    best, most = None, 0
    for cutoff, k, caught in zip(CUTOFFS, good_hit, bad_hit, strict=True):
        if k > risk * good or binomial_tail(int(k), int(good), risk) > level:
            break
        if caught - k > most:
            best, most = cutoff, caught - k
    return best


def proposed(good_hit: list[int], bad_hit: list[int], good: int, risk: float) -> list[tuple[str, float]]:
    """(rule, cutoff) in the order to test: fewest good documents first, then most gain. The lists hold CUTOFFS per rule, rule by rule."""
    n, found = len(CUTOFFS), []
    for i, rule in enumerate(RULES):
        good_of, bad_of = list(good_hit[i * n : (i + 1) * n]), list(bad_hit[i * n : (i + 1) * n])
        cutoff = certified_cutoff(good_of, bad_of, good, risk, 1.0)
        if cutoff is not None:
            at = CUTOFFS.index(cutoff)
            found.append((good_of[at], good_of[at] - bad_of[at], i, rule, cutoff))
    return [(rule, cutoff) for *_, rule, cutoff in sorted(found)]


def certified_steps(joint_hit: list[int], good: int, risk: float, level: float) -> int:
    """How many steps of a sequence hold; joint_hit: good documents that the rules up to each step reject together."""
    for step, k in enumerate(joint_hit):
        if binomial_tail(int(k), int(good), risk) > level:
            return step
    return len(joint_hit)


def propose_cutoffs(rates: DataFrame, risk: float) -> DataFrame:
    """stratum, steps, and a cut_ and a step_ column per rule (null: not proposed), from labelled documents.

    Counts are summed per stratum before anything is gathered: a stratum is one row, whatever its size.
    """
    hits = lambda q: F.array(*[F.count(F.when((F.col("quality") == q) & (F.col(r) > c), 1)) for r in RULES for c in CUTOFFS])
    per = rates.groupBy("stratum").agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"), hits(1).alias("good_hit"), hits(0).alias("bad_hit"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for s, good, good_hit, bad_hit in zip(b["stratum"], b["good"], b["good_hit"], b["bad_hit"], strict=True):
                path = proposed(list(good_hit), list(bad_hit), good, risk)
                cut, step = dict(path), {rule: i + 1 for i, (rule, _) in enumerate(path)}
                if path:
                    found.append((s, len(path), *[cut.get(r) for r in RULES], *[step.get(r) for r in RULES]))
            yield pd.DataFrame(found, columns=["stratum", "steps", *[f"cut_{r}" for r in RULES], *[f"step_{r}" for r in RULES]]).astype({f"cut_{r}": "float64" for r in RULES} | {f"step_{r}": "Int32" for r in RULES} | {"steps": "int32"})

    return per.mapInPandas(choose, ", ".join(["stratum string, steps int", *[f"cut_{r} double" for r in RULES], *[f"step_{r} int" for r in RULES]]))


def fit_cutoffs(labelled: DataFrame, risk: float, level: float, most_strata: int) -> DataFrame:
    """stratum and a cut_ column per rule (null: no cutoff) from labelled documents (doc_id, stratum, quality, a column per rule)."""
    proposes = fold("doc_id", 4) == 0
    path = settled(propose_cutoffs(labelled.filter(proposes), risk), "proposed")
    strata = path.count()
    tested = labelled.filter(~proposes & (F.col("quality") == 1)).join(F.broadcast(path) if strata <= most_strata else path, "stratum")
    hit = F.least(*[F.when(F.col(r) > F.col(f"cut_{r}"), F.col(f"step_{r}")) for r in RULES])
    joint = tested.withColumn("hit", hit).groupBy("stratum").agg(F.first("steps").alias("steps"), F.count(F.lit(1)).alias("good"), F.array(*[F.count(F.when(F.col("hit") <= k, 1)) for k in range(1, len(RULES) + 1)]).alias("joint_hit"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held = [certified_steps(list(k)[:steps], good, risk, level / strata) for k, steps, good in zip(b["joint_hit"], b["steps"], b["good"], strict=True)]
            yield pd.DataFrame({"stratum": b["stratum"], "held": held})

    held = joint.mapInPandas(judge, "stratum string, held int")
    return path.join(held, "stratum").select("stratum", *[F.when(F.col(f"step_{r}") <= F.col("held"), F.col(f"cut_{r}")).alias(f"cut_{r}") for r in RULES])


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, level: float = 0.05, most_strata: int = 10_000) -> DataFrame:
    """doc_id, COUNTS, base_failed, failed_rules, kept; a row per row of docs.

    docs: doc_id, text and the stratum column (null is a stratum of its own); labels: doc_id, quality (1 good), where a
    doc_id labelled twice counts as good only if every label says so. Per stratum, of good documents that pass the base
    rule at most the share risk is rejected by the rules together, with probability 1 - level for all strata at once. A null or empty text has no words and fails the
    base rule. Other columns are ignored. With no labels, no rule beyond the base applies. The table of cutoffs is
    broadcast only while it has at most most_strata strata.
    """
    stats = count_texts(docs.withColumn("stratum", F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit(""))), ["doc_id", "stratum"])
    stats = settled(stats, "text-counts")
    base = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    rates = stats.select("doc_id", "stratum", *[F.expr(f"least(1D, {e})").alias(r) for r, e in RULES.items()], base.alias("base_failed"))
    marked = with_free_names(labels, ["doc_id", "quality"]).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = settled(rates.filter("not base_failed").join(marked, "doc_id").select("doc_id", "stratum", "quality", *RULES), "labelled")
    wide = settled(fit_cutoffs(labelled, risk, level, most_strata), "cutoffs")
    if wide.count() <= most_strata:
        wide = F.broadcast(wide)
    failed = F.array_compact(F.array(*[F.when(F.expr(f"least(1D, {e})") > F.col(f"cut_{r}"), F.lit(r)) for r, e in RULES.items()]))
    return stats.join(wide, "stratum", "left").select("doc_id", *COUNTS, base.alias("base_failed"), failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))
