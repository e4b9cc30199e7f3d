"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word shingles, hashed to 64 bits; equal sets are one set from the start. The n-gram
universe is cut into fragments by hash. Fragments work independently: each counts, for the part of every set that falls
into it, how many n-grams also occur in another set, and these partial counts are summed per set. A set linked with any
other shares at least its size less the allowed difference, so a set with fewer shared n-grams has no link. This is
first asked of a slice of the universe for all sets, then of all n-grams for the sets that remain.

For the rest, n-grams are ordered by frequency, rarest first; only sets that meet in a prefix of that order can link. In
every prefix list all sets are first compared with one of them, and the links found are contracted to components. Then
fragments count again, now only n-grams that sets of different components share: what a component shares within itself
links it with nothing else, so most components are complete and drop out, however large they are. Only sets that remain
are compared with each other, and a pair is formed only where it can be the first n-gram that both share. N-grams with
long lists form no pairs: their sets are cut into so many parts that linked sets must hold equal n-grams in some of them,
and blocks of sets meet by the parts' signatures. Overlaps of pairs are counted fragment by fragment and summed per pair,
those of two blocks' sets by a product of matrices in a task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import U64, by_size, forget, map_batches, mix64, settled, token_hashes, windows, with_free_names
from tidelog.llm.components import components

ONE = U64(1)
#: Sets of up to so many n-grams are emitted whole in the first round.
SMALL = 64
#: 64-bit words of a set's bitmap; two sets differ in at least as many n-grams as their bitmaps in bits.
WORDS = 16
#: N-grams to a fragment and to a bundle of sets, and sets to a group that sums partial counts: memory of a task, whatever the input.
FRAGMENT, BUNDLE, GROUP = 200_000, 300_000, 20_000
#: Sets of an n-gram's list are compared with each other up to so many; sets of longer lists meet by signatures of parts.
LIST = 32
#: Sets and n-grams to a block whose sets one task compares with another block's: its memory, whatever the input.
BLOCK, BLOCK_GRAMS = 512, 500_000


@dataclass(frozen=True)
class Join:
    """Shingle words, similarity in percent, and how many fragments a pair's overlap is counted in."""

    words: int = 5
    percent: int = 80
    fragments: int = 4

    @property
    def slice(self) -> float:
        """Share of the n-gram universe looked at first: enough over the allowed difference to tell sets apart."""
        return min(1.0, 1.6 * (100 - self.percent) / 100)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes; fewer words than a shingle has are one shingle, no words none."""
        h = token_hashes((text or "").encode("utf-8", "surrogatepass"), lower=True)[0]
        return np.unique(windows(h, min(self.words, len(h)))) if len(h) else h


def set_id(shingles: np.ndarray) -> int:
    """Even 64-bit identity of a sorted set (the lowest bit is used as a mark elsewhere)."""
    if not len(shingles):
        return 0
    h = windows(shingles, 1)
    place = np.arange(1, 2 * len(h), 2, dtype=U64)
    mixed = np.add(np.bitwise_xor.reduce(h * place, keepdims=True), np.add.reduce(h, keepdims=True)) + U64(len(h))
    return int(windows(mixed, 1)[0] & ~ONE)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def describe(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, sid, n, looked: set identity and size, and how many of its n-grams the first round counts."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sid, n, looked = [], [], []
        for t in b.column("text").to_pylist():
            s = join.shingles(t)
            sid.append(set_id(s))
            n.append(len(s))
            looked.append(len(s) if len(s) <= SMALL else int(np.searchsorted(s, bound(join.slice))))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(signed(np.array(sid, U64))), pa.array(n, pa.int64()), pa.array(looked, pa.int64())], names=["doc_id", "sid", "n", "looked"])

    df = with_free_names(docs, ["doc_id", "text"])
    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, sid bigint, n bigint, looked bigint")


def bound(share: float) -> np.uint64:
    return U64(min((1 << 64) - 1, int(share * (1 << 64))))


def fragment_rows(sids: list[int], sets: list[np.ndarray], join: Join, first: bool, fragments: int) -> Iterator[pa.RecordBatch]:
    """Rows fragment, grams, sids of a batch of distinct sets; first: only the slice that the first round looks at.

    A sid's lowest bit says whether the n-gram counts for its set or is there for others. N-grams that several sets of
    the batch hold are counted here, sent on once without a sid, and their counts go to negative fragments.
    """
    grams, owners = [], []
    for sid, s in zip(sids, sets, strict=True):
        whole, cut = len(s) <= SMALL, int(np.searchsorted(s, bound(join.slice)))
        sent = len(s) if not first or len(s) * join.percent <= 100 * SMALL else cut
        counted = len(s) if not first or whole else cut
        grams.append(s[:sent])
        owners.append(np.where(np.arange(sent) < counted, U64(sid) | ONE, U64(sid)))
    g, o = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(g, kind="stable")
    g, o = g[order], o[order]
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    sizes = np.diff(np.append(starts, len(g)))
    shared = np.repeat(sizes > 1, sizes)
    own, counts = np.unique(o[shared & ((o & ONE) == ONE)], return_counts=True)
    g, o = np.concatenate((g[~shared], g[starts[sizes > 1]])), np.concatenate((o[~shared], np.zeros(np.count_nonzero(sizes > 1), U64)))
    f = (g % U64(fragments)).astype(np.int64)
    order = np.argsort(f, kind="stable")
    cuts = np.searchsorted(f[order], np.arange(fragments + 1))
    rows = [(i, g[order[a:b]].tobytes(), o[order[a:b]].tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    if len(own):
        rows.append((-1 - int(own[0] >> ONE) % fragments, counts.astype(np.int64).tobytes(), own.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["fragment", "grams", "sids"])


def count_shared(rows: DataFrame, parts: int) -> DataFrame:
    """sid, shared: n-grams of each set that occur in another one too, from fragment_rows.

    A fragment's partial counts leave it packed, in one row for each of `parts` groups of sets; a group then sums them.
    Empty rows aren't made, so there are never more of them than n-grams.
    """

    def count(t: pa.Table) -> pa.Table:
        g = np.frombuffer(b"".join(t.column("grams").to_pylist()), U64)
        o = np.frombuffer(b"".join(t.column("sids").to_pylist()), U64)
        if t.column("fragment")[0].as_py() < 0:
            own, counts = o, signed(g)
        else:
            order = np.lexsort((o, g))
            g, o = g[order], o[order]
            keep = np.append(True, (g[1:] != g[:-1]) | (o[1:] != o[:-1]))
            g, o = g[keep], o[keep]
            starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            sizes = np.diff(np.append(starts, len(g)))
            own, counts = np.unique(o[np.repeat((sizes > 1) | (o[starts] == 0), sizes) & ((o & ONE) == ONE)], return_counts=True)
        group = ((own >> ONE) % U64(parts)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(parts + 1))
        packed = [(k, own[order[a:b]].tobytes(), counts[order[a:b]].astype(np.int64).tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.table({"part": pa.array([x[0] for x in packed], pa.int64()), "sids": pa.array([x[1] for x in packed], pa.binary()), "counts": pa.array([x[2] for x in packed], pa.binary())})

    def total(t: pa.Table) -> pa.Table:
        own, at = np.unique(np.frombuffer(b"".join(t.column("sids").to_pylist()), U64), return_inverse=True)
        shared = np.bincount(at, weights=np.frombuffer(b"".join(t.column("counts").to_pylist()), np.int64), minlength=len(own))
        return pa.table({"sid": signed(own & ~ONE), "shared": shared.astype(np.int64)})

    partial = rows.groupBy("fragment").applyInArrow(count, "part bigint, sids binary, counts binary")
    return partial.groupBy("part").applyInArrow(total, "sid bigint, shared bigint")


def first_round(docs: DataFrame, join: Join, fragments: int, parts: int) -> DataFrame:
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = {set_id(s): s for t in b.column("text").to_pylist() if len(s := join.shingles(t))}
        if sets:
            yield from fragment_rows(list(sets), list(sets.values()), join, True, fragments)

    return count_shared(map_batches(with_free_names(docs, ["text"]), run, "fragment bigint, grams binary, sids binary"), parts)


def spare(join: Join):
    """N-grams of a set (column n) that a linked set may lack."""
    return F.col("n") - F.floor((F.lit(join.percent) * F.col("n") + 99) / 100)


def full_sets(docs: DataFrame, chosen: DataFrame, join: Join, most_broadcast: int = 1_000_000) -> DataFrame:
    """sid, n, grams of the chosen documents (doc_id, sid, n); chosen is broadcast only up to most_broadcast rows."""
    if chosen.count() <= most_broadcast:
        chosen = F.broadcast(chosen)
    df = with_free_names(docs, ["doc_id", "text"]).join(chosen, "doc_id")

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = {}
        for sid, t in zip(b.column("sid").to_pylist(), b.column("text").to_pylist(), strict=True):
            s = join.shingles(t)
            if set_id(s) == sid & ((1 << 64) - 1):  # a doc_id may occur with several texts
                sets[sid] = s
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array([len(s) for s in sets.values()], pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())], names=["sid", "n", "grams"])

    return settled(map_batches(df.select("sid", "text"), run, "sid bigint, n bigint, grams binary").dropDuplicates(["sid"]), "sets")


def bundled(sets: DataFrame) -> DataFrame:
    """Sets (sid, root, n, grams) packed into bundles of bounded size, each known by the sid of its first set."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sids, roots, grams = b.column("sid").to_numpy(), b.column("root").to_numpy(), b.column("grams").to_pylist()
        sizes = np.array([len(g) // 8 for g in grams], np.int64)
        for part in runs(sizes.tolist(), BUNDLE):
            packed = [sids[part].tobytes(), roots[part].tobytes(), sizes[part].tobytes(), b"".join(grams[part])]
            yield pa.RecordBatch.from_arrays([pa.array(sids[part][:1]), *[pa.array([x], pa.binary()) for x in packed]], names=["bundle", "sids", "roots", "sizes", "grams"])

    return settled(map_batches(sets.select("sid", "root", "grams"), run, "bundle bigint, sids binary, roots binary, sizes binary, grams binary"), "bundles")


def runs(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum to at most `most`, or of one item."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def arrays(b: pa.RecordBatch | pa.Table, i: int, *names: str) -> list[np.ndarray]:
    return [np.frombuffer(b.column(c)[i].as_py(), np.int64) for c in names]


def foreign(bundles: DataFrame, fragments: int) -> DataFrame:
    """The bundles with known (array of packed grams and counts): their n-grams that sets of several roots hold, and how many sets hold them.

    A bundle asks once for each n-gram, whatever the number of its sets that hold it.
    """

    def ask(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(b.num_rows):
            roots, sizes, g = arrays(b, i, "roots", "sizes", "grams")
            order = np.argsort(g, kind="stable")
            g, r = g[order], np.repeat(roots, sizes)[order]
            starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            least, most = np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)
            g, root, held = g[starts], np.where(least == most, least, 0), np.diff(np.append(starts, len(g)))
            f = (g.view(U64) % U64(fragments)).astype(np.int64)
            order = np.argsort(f, kind="stable")
            cuts = np.searchsorted(f[order], np.arange(fragments + 1)).tolist()
            rows = [(k, b.column("bundle")[i].as_py(), *[x[order[s:e]].tobytes() for x in (g, root, held)]) for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if e > s]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["fragment", "bundle", "grams", "roots", "held"])

    def answer(t: pa.Table) -> pa.Table:
        g, root, held = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.int64) for c in ("grams", "roots", "held"))
        of = np.repeat(np.arange(t.num_rows), [len(x.as_py()) // 8 for x in t.column("grams")])
        order = np.argsort(g, kind="stable")
        starts = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1]))
        sizes, r = np.diff(np.append(starts, len(g))), root[order]
        least, most = np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)
        several = (least != most) | (np.logical_or.reduceat(r == 0, starts))
        total, told = np.zeros(len(g), np.int64), np.zeros(len(g), bool)
        total[order], told[order] = np.repeat(np.add.reduceat(held[order], starts), sizes), np.repeat(several, sizes)
        cuts = np.searchsorted(of[told], np.arange(t.num_rows + 1)).tolist()
        g, total = g[told], total[told]
        rows = [(to, g[s:e].tobytes(), total[s:e].tobytes()) for to, s, e in zip(t.column("bundle").to_pylist(), cuts[:-1], cuts[1:], strict=True) if e > s]
        return pa.table({"bundle": pa.array([x[0] for x in rows], pa.int64()), "grams": pa.array([x[1] for x in rows], pa.binary()), "held": pa.array([x[2] for x in rows], pa.binary())})

    asked = map_batches(bundles.select("bundle", "roots", "sizes", "grams"), ask, "fragment bigint, bundle bigint, grams binary, roots binary, held binary")
    told = asked.groupBy("fragment").applyInArrow(answer, "bundle bigint, grams binary, held binary").groupBy("bundle").agg(F.collect_list(F.struct("grams", "held")).alias("known"))
    return bundles.join(told, "bundle")


def prefixes(known: DataFrame, join: Join) -> DataFrame:
    """gram, sid, root, n, place, shared: the n-grams of each set in which every set it links with, of another root, must meet it.

    place: of all n-grams that several roots hold, rarest first, from 0; shared: how many of these the set has. Sets that
    share too few with other roots have no rows.
    """

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(b.num_rows):
            sids, roots, n, g = arrays(b, i, "sids", "roots", "sizes", "grams")
            told = b.column("known")[i].as_py()
            grams, held = (np.frombuffer(b"".join(x[c] for x in told), np.int64) for c in ("grams", "held"))
            order = np.argsort(grams)
            grams, held = grams[order], held[order]
            at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
            own = np.repeat(np.arange(len(n)), n)
            hit = grams[at] == g
            g, own, rare = g[hit], own[hit], held[at[hit]]
            shared = np.bincount(own, minlength=len(n))
            room = n - (join.percent * n + 99) // 100 + 1 - (n - shared)  # places in the prefix that such n-grams take
            order = np.lexsort((g, rare, own))
            g, own = g[order], own[order]
            place = np.arange(len(own)) - np.repeat(np.cumsum(shared) - shared, shared)
            keep = place < room[own]
            g, own, place = g[keep], own[keep], place[keep]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g, sids[own], roots[own], n[own], place, shared[own])], names=["gram", "sid", "root", "n", "place", "shared"])

    return settled(map_batches(known, run, "gram bigint, sid bigint, root bigint, n bigint, place bigint, shared bigint"), "prefixes")


def bitmaps(sets: DataFrame) -> DataFrame:
    """sid, bits: a bit for each n-gram's hash."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for x in b.column("grams").to_pylist():
            at = (np.frombuffer(x, U64) >> U64(7)) % U64(64 * WORDS)
            flags = np.zeros(64 * WORDS, np.uint8)
            flags[at.astype(np.int64)] = 1
            out.append(np.packbits(flags).view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([b.column("sid"), pa.array(out, pa.list_(pa.int64()))], names=["sid", "bits"])

    return map_batches(sets.select("sid", "grams"), run, "sid bigint, bits array<bigint>")


def may_link(join: Join):
    """Condition on a pair of prefix rows (columns …_a, …_b): sizes, places and bitmaps allow the similarity.

    The n-gram counts as the first that both share, so no more are shared than either has from there on.
    """
    open_ = F.least(F.col("shared_a") - F.col("place_a"), F.col("shared_b") - F.col("place_b"))
    return alike_in_size("n_a", "n_b", join) & (open_ >= needed(join)) & alike_in_bits(join)


def needed(join: Join):
    """N-grams that a pair must share."""
    return (F.col("n_a") + F.col("n_b")) * join.percent / (100 + join.percent) - 1e-6


def alike_in_bits(join: Join):
    apart = sum((F.bit_count(F.col(f"w{i}_a").bitwiseXOR(F.col(f"w{i}_b"))).cast("double") for i in range(WORDS)), F.lit(0.0))
    return apart <= F.col("n_a") + F.col("n_b") - 2 * needed(join)


def alike_in_size(a: str, b: str, join: Join):
    return (F.col(a) * 100 >= F.col(b) * join.percent) & (F.col(b) * 100 >= F.col(a) * join.percent)


def size_classes(percent: int, upto: int) -> list[int]:
    """Least sizes of classes: two sets that link are of the same class or of neighbouring ones."""
    least = [1]
    while least[-1] <= upto:
        least.append(least[-1] * 100 // percent + 1)
    return [*least, least[-1] * 100 // percent + 1]


def part_signatures(s: np.ndarray, c: int, most: int, percent: int) -> np.ndarray:
    """Signatures of a set's parts for pairs of sets of at most `most` n-grams: linked sets have one in common.

    Linked sets differ in at most d n-grams, so of m parts m - d are equal. A set leaves out its sparsest parts, those of
    up to z n-grams, for the largest z of which it has fewer than m - d; the greater of two linked sets' z still leaves
    an equal part that both keep, since equal parts are equally large.
    """
    d = 2 * most * (100 - percent) // (100 + percent)
    m = d + 1 + int(1.5 * d * exp(-most * percent / 100 / max(d, 1)) + 0.5)  # as many more as will be empty
    salt = mix64(np.array([c + 1], U64))
    part = (mix64(s + salt) % U64(m)).astype(np.int64)
    sizes = np.bincount(part, minlength=m)
    sparse = np.cumsum(np.bincount(sizes))  # parts of up to that many n-grams
    sizes_kept = sizes > int(np.searchsorted(sparse, m - d)) - 1
    order = np.argsort(part, kind="stable")
    sums = np.zeros(m, U64)
    filled = np.flatnonzero(sizes)
    sums[filled] = np.add.reduceat(mix64(s[order] ^ salt), np.cumsum(sizes[filled]) - sizes[filled])
    return mix64(sums + mix64(np.arange(m, dtype=U64) + salt))[sizes_kept]


def met_by_parts(sets: DataFrame, bits: DataFrame, join: Join) -> DataFrame:
    """Links a, b between sets (sid, root, n, grams) of different roots; with the roots' own they connect what all links do.

    Linked sets have an equal part. Sets go to blocks with others of their parts, blocks meet where a part in one equals
    one in the other, and a task counts exactly what the sets of two blocks share; so a row is made for two blocks and a
    part, and for a link, never for two sets that don't link. A set has a row per part, some six tenths of its n-grams at
    80 percent, a quarter at 90. bits aren't needed, as counts are exact.
    """
    percent = join.percent

    def sign(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        least = size_classes(percent, max(b.column("n").to_pylist()))
        for sid, root, n, x in zip(*(b.column(c).to_pylist() for c in ("sid", "root", "n", "grams")), strict=True):
            own, s = bisect_right(least, n) - 1, np.frombuffer(x, U64)
            for c in (own, own + 1):  # pairs whose greater class is c
                found = signed(part_signatures(s, c, least[c + 1] - 1, percent))
                k = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(found), *[pa.array(np.full(k, v, np.int64)) for v in (c - own, sid, root, n)]], names=["signature", "below", "sid", "root", "n"])

    rows = map_batches(sets.select("sid", "root", "n", "grams"), sign, "signature bigint, below bigint, sid bigint, root bigint, n bigint")
    marked = settled(rows, "signatures")
    several = marked.groupBy("signature").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("signature")
    met = settled(marked.join(several, "signature").select("signature", "below", "sid", "n"), "met")
    forget(marked)
    places = settled(placed(met), "places")
    held = met.join(places, "sid").groupBy("signature", "block").agg(F.min("below").alias("below"))
    x, y = (held.select("signature", F.col("block").alias(e), F.col("below").alias(f"below_{e}")) for e in "pq")
    both = settled(x.join(y, "signature").filter("p <= q and below_p + below_q < 2").select("p", "q").distinct(), "blocks")
    packed = settled(sets.join(places, "sid").select("block", "sid", "root", "n", "grams").groupBy("block").applyInArrow(pack, "block bigint, sids binary, roots binary, sizes binary, grams binary"), "packed")
    forget(met, places)

    def compare(t: pa.Table) -> pa.Table:
        (sids_a, roots_a, n_a, g_a), (sids_b, roots_b, n_b, g_b) = (arrays(t, i, "sids", "roots", "sizes", "grams") for i in (0, t.num_rows - 1))
        shared = overlaps(n_a, g_a, n_b, g_b)
        i, j = np.nonzero((shared * 100 >= (n_a[:, None] + n_b - shared) * percent) & (roots_a[:, None] != roots_b))
        kept = forest(roots_a[i].tolist(), roots_b[j].tolist())
        return pa.table({"a": sids_a[i[kept]], "b": sids_b[j[kept]]})

    asked = both.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    return asked.join(packed, "block").groupBy("p", "q").applyInArrow(compare, "a bigint, b bigint")


def placed(met: DataFrame) -> DataFrame:
    """sid, block: sets of the same least signature go to the same blocks, of about BLOCK sets or BLOCK_GRAMS n-grams."""
    pieces = lambda k, n: F.ceil(F.greatest(k / BLOCK, n / BLOCK_GRAMS))
    own = settled(met.groupBy("sid").agg(F.min(F.struct("below", "signature"))["signature"].alias("key"), F.max("n").alias("n")), "own")
    sized = own.groupBy("key").agg(pieces(F.count("*"), F.sum("n")).alias("of"))
    small = own.agg(F.coalesce(pieces(F.count("*"), F.sum("n")), F.lit(1))).first()[0]  # blocks that hold several keys
    one, many = F.pmod(F.xxhash64("key"), F.lit(max(1, small))), F.xxhash64("key", F.pmod(F.xxhash64("sid"), F.col("of")))
    return own.join(sized, "key").select("sid", F.when(F.col("of") > 1, many).otherwise(one).alias("block"))


def pack(t: pa.Table) -> pa.Table:
    """A block's sets in one row."""
    grams = t.column("grams").to_pylist()
    sizes = np.array([len(g) // 8 for g in grams], np.int64)
    packed = [t.column("sid").to_numpy().tobytes(), t.column("root").to_numpy().tobytes(), sizes.tobytes(), b"".join(grams)]
    return pa.table({"block": t.column("block")[:1], **{c: pa.array([x], pa.binary()) for c, x in zip(("sids", "roots", "sizes", "grams"), packed, strict=True)}})


def overlaps(n_a: np.ndarray, g_a: np.ndarray, n_b: np.ndarray, g_b: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many n-grams each set of a block (sizes, n-grams) shares with each of another: products of 0/1 matrices, some columns at a time."""
    common, found = np.intersect1d(g_a, g_b), np.zeros((len(n_a), len(n_b)), np.int64)
    if not len(common):
        return found
    sides = []
    for n, g in ((n_a, g_a), (n_b, g_b)):
        at = np.minimum(np.searchsorted(common, g), len(common) - 1)
        hit = common[at] == g
        at, own = at[hit], np.repeat(np.arange(len(n)), n)[hit]
        order = np.argsort(at, kind="stable")
        sides.append((len(n), at[order], own[order]))
    for begin in range(0, len(common), width):
        parts = []
        for k, at, own in sides:
            lo, hi = np.searchsorted(at, (begin, begin + width))
            m = np.zeros((k, width), np.float32)
            m[own[lo:hi], at[lo:hi] - begin] = 1
            parts.append(m)
        found += (parts[0] @ parts[1].T).astype(np.int64)
    return found


def forest(a: list[int], b: list[int]) -> list[int]:
    """Places of links that connect what all links a[i], b[i] do."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = top(x), top(y)
        if x != y:
            up[x] = y
            kept.append(i)
    return kept


def met_by_grams(rows: DataFrame, join: Join) -> DataFrame:
    """Pairs a, b of prefix rows with bitmaps (words w0, w1, …) that may link, of n-grams with short lists."""
    x, y = (rows.select("gram", *[F.col(c).alias(f"{c}_{e}") for c in rows.columns if c != "gram"]) for e in "ab")
    pairs = x.join(y, "gram").filter((F.col("sid_a") < F.col("sid_b")) & (F.col("root_a") != F.col("root_b")) & may_link(join))
    return pairs.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the limit; overlaps are counted per fragment and summed per pair."""
    v = join.fragments

    def cut(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for sid, n, x in zip(b.column("sid").to_pylist(), b.column("n").to_pylist(), b.column("grams").to_pylist(), strict=True):
            s = np.frombuffer(x, U64)
            edges = np.searchsorted(s, np.array([(i << 64) // v for i in range(1, v)], U64)).tolist()
            rows += [(sid, n, i, s[lo:hi].tobytes()) for i, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(s)], strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["sid", "n", "part", "grams"])

    parts = map_batches(sets, cut, "sid bigint, n bigint, part int, grams binary")
    left = parts.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), "part", F.col("grams").alias("of_a"))
    right = parts.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), "part", F.col("grams").alias("of_b"))

    def overlap(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        both = [len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True)) for x, y in zip(b.column("of_a").to_pylist(), b.column("of_b").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("a", "b", "n_a", "n_b")], pa.array(both, pa.int64())], names=["a", "b", "n_a", "n_b", "both"])

    counted = map_batches(pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "n_a", "n_b", "of_a", "of_b"), overlap, "a bigint, b bigint, n_a bigint, n_b bigint, both bigint")
    summed = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    return summed.filter(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * join.percent).select("a", "b")


def links(docs: DataFrame, described: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) between different sets that connect the same sets as all links do."""
    reps = settled(described.filter("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("doc_id"), F.min("looked").alias("looked")), "sets")
    n_sets, n_grams = reps.agg(F.count("*"), F.coalesce(F.sum("looked"), F.lit(0))).first()
    shared = first_round(docs, join, pieces(n_grams, FRAGMENT), pieces(n_sets, GROUP))
    kept = reps.join(shared, "sid", "left").filter(F.coalesce("shared", F.lit(0)) >= F.col("looked") - spare(join)).filter("doc_id is not null").select("doc_id", "sid", "n")
    kept = settled(kept, "chosen")
    sets = full_sets(docs, kept.drop("n"), join)
    forget(kept, reps)
    fragments = pieces(sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], FRAGMENT)

    bundles = bundled(sets.withColumn("root", F.col("sid")))
    prefix = prefixes(foreign(bundles, fragments), join)
    forget(bundles)
    hubs = prefix.groupBy("gram").agg(F.min(F.struct((F.col("n") - F.col("shared")).alias("alone"), "sid", "n")).alias("hub"))  # the set with least of its own is nearest to all others
    first = prefix.join(hubs, "gram").select(F.col("hub.sid").alias("a"), F.col("hub.n").alias("n_a"), F.col("sid").alias("b"), F.col("n").alias("n_b")).filter("a != b")
    found = settled(verified(first.filter(alike_in_size("n_a", "n_b", join)).select("a", "b").distinct(), sets, join), "links")

    roots = by_size(components(found).withColumnRenamed("node", "sid"))
    rest = sets.join(by_size(prefix.select("sid").distinct()), "sid", "left_semi").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    bundles, whole = bundled(rest), prefix
    prefix = prefixes(foreign(bundles, fragments), join)
    forget(bundles, whole)
    mixed = prefix.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("held")).filter("lo != hi").select("gram", "held")
    listed = settled(prefix.join(mixed, "gram"), "open")
    words = [F.col("bits")[i].alias(f"w{i}") for i in range(WORDS)]
    bits = settled(bitmaps(sets.join(by_size(listed.select("sid").distinct()), "sid", "left_semi")).select("sid", *words), "bits")
    pairs = met_by_grams(listed.filter(F.col("held") <= LIST).drop("held").join(bits, "sid"), join)
    crowded = settled(listed.filter(F.col("held") > LIST).select("sid", "root").distinct(), "crowded")
    if not crowded.isEmpty():
        pairs = pairs.unionByName(met_by_parts(sets.join(by_size(crowded), "sid"), bits, join)).distinct()
    done = settled(found.unionByName(verified(pairs, sets, join)), "links")
    forget(found, listed, bits, crowded, prefix, sets)
    return done


def pieces(total: int, each: int) -> int:
    """How many pieces of about `each` a total makes; some at least, for small tables to use all cores."""
    return max(24, -(-total // each))


def ngram_components(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links reach, a row per row of docs.

    Words are runs of anything but blank and \\t-\\r, A-Z as a-z. Null, empty and wordless texts have no shingles and
    are their own component; a text with fewer words than a shingle is one shingle. Equal sets are linked. Rows
    without doc_id belong to a component without lending it an id, and connect nothing beyond equal sets. Other
    columns are ignored. Every text is read whole three times, its text is never shuffled unless the sets left for
    comparison outgrow a checked size.
    """
    join = join or Join()
    described = settled(describe(docs, join), "described")
    roots = components(links(docs, described, join)).withColumnRenamed("node", "sid")
    own = described.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    own = own.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    of_root = own.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = own.join(of_root, "root").select("sid", "component_id")
    found = described.filter("n > 0").join(classes, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(described.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
