import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import DOCS, documents, pairs, texts
from tests.llm.test_text_operators import plain_base
from tests.oracle import duck_rows, spark_rows
from tokenizers import Tokenizer

from tidelog.llm import chat_format, ngram_join, secret_scan, suffix_dedup
from tidelog.llm.components import components
from tidelog.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    """Least id by exhaustive comparison."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    docs = documents(spark).cache()
    found = ngram_join.ngram_components(docs, ngram_join.Join(words=k, percent=percent)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(pairs(docs), k, percent)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 60)])
def test_components_where_every_list_is_crowded(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "LIST", 1)
    r = np.random.default_rng(k)
    pool = [" ".join(f"w{x}" for x in r.integers(0, 60, 9)) for _ in range(12)]
    rows = [(i, ". ".join(pool[x] for x in r.integers(0, 12, r.integers(1, 25)))) for i in range(200)]
    rows += [(1000 + i, t.replace("w7", "w8", 1) + " more" * (i % 3)) for i, t in rows[::2]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(documents(spark).select("doc_id", "text")).cache()
    found = ngram_join.ngram_components(docs, ngram_join.Join(words=k, percent=percent)).collect()
    assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in found) == brute_components(pairs(docs), k, percent)


def test_parts_hold_every_link_and_few_other_pairs(spark):
    r = np.random.default_rng(3)
    hashes = ngram_join.mix64(np.arange(1, 4000, dtype=np.uint64))
    for percent in (60, 80, 90, 95, 100):
        least = ngram_join.size_classes(percent, 4000)
        for _ in range(300):
            n = int(r.integers(1, 400))
            a = r.choice(hashes, n, replace=False)
            drop = int(r.integers(0, n * (100 - percent) // 100 + 1))
            room = (n - drop) * 100 // percent - n  # of a union's size
            b = np.concatenate((a[drop:], r.choice(np.setdiff1d(hashes, a), int(r.integers(0, max(room, 0) + 1)), replace=False)))
            if len(np.intersect1d(a, b)) * 100 < percent * len(np.union1d(a, b)):
                continue
            c = max(np.searchsorted(least, len(x), "right") - 1 for x in (a, b))
            assert c - min(np.searchsorted(least, len(x), "right") - 1 for x in (a, b)) <= 1
            found = [ngram_join.part_signatures(np.sort(x), c, least[c + 1] - 1, percent) for x in (a, b)]
            assert len(np.intersect1d(*found)), (percent, n, len(b))


def test_texts_of_one_pool_form_few_pairs(spark, monkeypatch):
    """Texts of 30 sentences out of 20, which hardly link but nearly all share n-grams with each other: few of their pairs are compared."""
    compared = []
    plain = ngram_join.verified
    join = ngram_join.Join(words=3, percent=90)

    def counted(pairs, sets, join):
        compared[-1] += pairs.count()
        return plain(pairs, sets, join)

    def grams(rows, join):
        held = rows.groupBy("gram").count()
        compared[-1] += held.selectExpr("coalesce(sum(count * (count - 1) div 2), 0)").first()[0]
        return plain_grams(rows, join)

    def parts(sets, bits, join):
        monkeypatch.setattr(ngram_join, "alike_in_bits", lambda join: F.lit(True))  # pairs are counted before bitmaps part them
        met = plain_parts(sets, bits, join).cache()
        monkeypatch.setattr(ngram_join, "alike_in_bits", plain_bits)
        compared[-1] += met.count()
        return met

    plain_grams, plain_parts, plain_bits = ngram_join.met_by_grams, ngram_join.met_by_parts, ngram_join.alike_in_bits
    for name, f in (("verified", counted), ("met_by_grams", grams), ("met_by_parts", parts)):
        monkeypatch.setattr(ngram_join, name, f)
    r = np.random.default_rng(1)
    pool = [" ".join(f"s{i}w{x}" for x in range(10)) for i in range(20)]
    for n in (1000, 2000, 4000):
        rows = [(i, " ".join(pool[x] for x in r.integers(0, 20, 30))) for i in range(n)]
        compared.append(0)
        ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), join).count()
    assert all(100 * c < 4 * n * (n - 1) // 2 for n, c in zip((2000, 4000), compared[1:], strict=True)), compared


def sets_of(spark, texts, join):
    rows = [(int(ngram_join.set_id(s) >> 1), len(s), s.tobytes()) for s in map(join.shingles, texts)]
    return spark.createDataFrame([(i, i, n, g) for i, n, g in rows], "sid bigint, root bigint, n bigint, grams binary")


def test_copies_just_below_the_limit_form_no_rows(spark):
    """Copies of one text with five words changed each, 78 percent alike: bitmaps don't part them, so nearly all pairs were rows."""
    r = np.random.default_rng(5)
    words, join = [f"w{i}" for i in range(400)], ngram_join.Join(words=5, percent=80)
    texts = []
    for k in range(60):
        own = list(words)
        for at in r.choice(np.arange(2, 79), 5, replace=False) * 5:
            own[at] = f"x{k}y{at}"
        texts.append(" ".join(own))
    texts.append(" ".join(words[:380]))  # links with some
    sets = sets_of(spark, texts, join)
    bits = ngram_join.bitmaps(sets).select("sid", *[F.col("bits")[i].alias(f"w{i}") for i in range(ngram_join.WORDS)])
    found = {tuple(sorted(x)) for x in ngram_join.met_by_parts(sets, bits, join).collect()}
    held = [(int(ngram_join.set_id(join.shingles(t)) >> 1), shingles(t, 5)) for t in texts]
    links = {tuple(sorted((i, j))) for k, (i, a) in enumerate(held) for j, b in held[:k] if 100 * len(a & b) >= 80 * len(a | b)}
    assert links and found <= links and len(found) < len(texts)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_where_sets_fill_many_blocks(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "LIST", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    r = np.random.default_rng(11)
    base = [f"w{x}" for x in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in r.integers(0, 120, r.integers(0, 6)):
            own[at] = f"x{r.integers(0, 30)}"
        rows.append((i, " ".join(own[: int(r.integers(90, 121))])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").cache()
    found = ngram_join.ngram_components(docs, ngram_join.Join(words=k, percent=percent)).collect()
    assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in found) == brute_components(pairs(docs), k, percent)


def test_overlaps_and_forest():
    r = np.random.default_rng(2)
    a, b = ([np.unique(r.integers(0, 90, r.integers(1, 60))) for _ in range(k)] for k in (7, 5))
    sizes = [np.array([len(x) for x in own]) for own in (a, b)]
    found = ngram_join.overlaps(sizes[0], np.concatenate(a), sizes[1], np.concatenate(b), width=16)
    assert found.tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert ngram_join.forest([1, 2, 1, 5], [2, 3, 3, 6]) == [0, 1, 3]


def test_components_of_a_real_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = QUERIES["op2_ngram_jaccard"](spark, sf).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(pairs(docs), 3, 90)


def test_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert ngram_join.ngram_components(none).count() == 0
    assert suffix_dedup.repeat_summary(none).count() == 0


def test_long_chain_of_links(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(links).filter("root != 0").count() == 0


def test_components_of_nulls_loops_and_nothing(spark):
    rows = [(5, 5), (None, 1), (1, None), (None, None), (3, 2), (2, 3), (3, 2), (9, 4), (4, 7), (6, 6)]
    found = components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, found)) == [(2, 2), (3, 2), (4, 4), (7, 4), (9, 4)]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_repeats(found, length):
    data = [(d, (t or "").encode()) for d, t in found]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    out = Counter()
    for d, t in data:
        cover, spans = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(cover)))
        kept = bytes(x for x, c in zip(t, cover, strict=True) if not c)
        out[(d, len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length", [200, 64])
def test_repeats_equal_brute_force(spark, length):
    docs = documents(spark).cache()
    found = suffix_dedup.repeat_summary(docs, length).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == brute_repeats(pairs(docs), length)


@pytest.mark.parametrize("hot", [0, 3])
def test_large_groups_are_counted_string_by_string(spark, hot):
    docs = documents(spark, [*texts(3, 10), "ab " * 300, "ab " * 200 + "z"]).filter("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    found = suffix_dedup.find_repeats(docs, 64, hot).join(suffix_dedup.with_rid(docs), "rid").collect()
    want = {d: (removed, sha) for d, _, removed, _, sha in brute_repeats(pairs(docs), 64) if removed}
    assert {r["doc_id"]: (sum(e - b for b, e in zip(r["begins"], r["ends"], strict=True)), hashlib.sha256(r["kept"]).hexdigest()) for r in found} == want


def test_multikey_order_is_that_of_bytes():
    r = np.random.default_rng(2)
    rows, group = r.integers(0, 2, (400, 29), np.uint8), np.sort(r.integers(0, 20, 400))
    rows[100:300] = rows[100 + r.integers(0, 3, 200)]
    order = suffix_dedup.multikey(rows, group)
    assert [(group[i], rows[i].tobytes()) for i in order] == sorted((g, x.tobytes()) for g, x in zip(group, rows, strict=True))


def test_pieces_of_long_texts_have_the_same_anchors(monkeypatch):
    r = np.random.default_rng(3)
    found = [bytes(r.integers(97, 100, n, np.uint8)) for n in (10, 5000, 199, 200, 201, 3000)]
    anchors = lambda: {(i, p, h) for own, place, of in suffix_dedup.anchor_sides(found, 200) for i, p, h in zip(own.tolist(), place.tolist(), of.tolist(), strict=True)}
    want = anchors()
    for chunk in (1, 100, 777):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        assert anchors() == want


def test_equal_hashes_of_different_strings_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "hashes", lambda sums, width: np.zeros((sums.shape[0], sums.shape[1] - width), np.uint64))
    x = suffix_dedup.Suffixes.joined([suffix_dedup.Suffixes.at(t, i + 1, np.array([40]), 64) for i, t in enumerate((b"a" * 20 + b"m" * 100, b"b" * 30 + b"m" * 90, b"c" * 200))])
    rid, begin, end = suffix_dedup.by_string(x)
    assert sorted(zip(rid.tolist(), begin.tolist(), end.tolist(), strict=True)) == [(1, 30, 104), (2, 30, 104)]


def test_removal_keeps_rows(spark):
    docs = documents(spark).cache()
    done = suffix_dedup.remove_repeats(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert done.filter("text is null").count() == docs.filter("text is null").count()
    assert suffix_dedup.repeat_summary(done.filter("text is not null")).agg(F.max("n_removed")).first()[0] <= suffix_dedup.repeat_summary(docs).agg(F.max("n_removed")).first()[0]


ROWS = [(1, 0, "user", "</s>[INST] ok [/INST] [\\INST] \\"), (1, 1, "assistant", "<s>[\\\\/INST]"), (1, 1, "assistant", "<s>[\\\\/INST]"), (2, 0, "assistant", None), (2, None, None, "x"), (3, 5, "odd [AS] role", "[TURN]"), (3, 6, "tool", ""), (None, 0, "user", "é🙂"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a")]


def test_chats_read_back(spark):
    df = spark.createDataFrame([(*r, "c") for r in ROWS], "conv_id bigint, turn bigint, role string, text string, segments string")
    done = chat_format.format_chats(df).withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("learned", chat_format.loss_text(F.col("segments"))).collect()
    want = {}
    for c, turn, role, text in sorted(ROWS, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in done} == want
    assert {r["conv_id"]: r["learned"] for r in done} == {c: "".join(t for r, t in turns if r == "assistant") for c, turns in want.items()}
    assert {r["conv_id"]: r["valid"] for r in done} == {1: False, 2: False, 3: False, None: False, 4: True}
    assert {r["conv_id"]: r["first_bad_turn"] for r in done}[1] == 2
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_chats_equal_sql(spark, sf):
    assert spark_rows(QUERIES["op10_chat_format"](spark, sf)) == duck_rows(ORACLE_SQL["op10_chat_format"], sf)


def test_marks_must_be_defusable():
    with pytest.raises(ValueError, match="marks"):
        chat_format.ChatTemplate(other=chat_format.Turn("<<A>", "</A>"))


def brute_cut(found, length):
    """(doc_id, text) without what is repeated; characters that lose a byte go whole."""
    data = [(d, t.encode()) for d, t in found]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    for d, t in data:
        kept = bytearray(b"\1" * len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                kept[i : i + length] = bytes(length)
        yield d, bytes(x for x, k in zip(t, kept, strict=True) if k).decode("utf-8", "ignore")


def brute_mask(text):
    """Every character that a base pattern or a decoded key covers, a mask for each run of overlapping ones."""
    found = [tuple(map(int, s.split(":")[1:])) for s in plain_base(text).split(",") if s] + [(s, e) for s, e, _ in secret_scan.confirmed_spans(text)]
    joined = []
    for s, e in sorted(found):
        if joined and s < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    for s, e in reversed(joined):
        text = text[:s] + "[SECRET]" + text[e:]
    return text


def test_pipeline(spark, sf, tmp_path):
    """The whole output against all five stages by brute force; no text of the table that has a letter is beyond its languages."""
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "suffix_dedup", "secret_scan", "packing"]
    table = spark.read.parquet(f"{sf}/documents.parquet")
    secrets = ["password = hunter22x", f"AKIA{'Q7' * 9} and token: 'abc123def'", f"api_key={'0a1b' * 9}", "secret: short", f"x{'9f' * 20}-"]
    table = table.withColumn("text", F.concat("text", F.lit(" "), F.element_at(F.array(*map(F.lit, secrets)), (F.col("doc_id") % 5 + 1).cast("int"))))
    odd = [(10_000, None), (10_001, ""), (10_002, "12 + 34 = 46"), (10_003, " \n\t")]
    sf = str(tmp_path)
    table.unionByName(spark.createDataFrame([(*x, "en", None, None) for x in odd], table.schema)).write.parquet(f"{sf}/documents.parquet")
    docs = [(d, t) for d, t in pairs(spark.read.parquet(f"{sf}/documents.parquet")) if any(c.isalpha() for c in t or "")]
    near = {d for d, _, c in brute_components(docs, 5, 80) if d == c}
    want = {d: brute_mask(t) for d, t in brute_cut([x for x in docs if x[0] in near], 200)}
    before = dict(docs)
    assert len(near) < len(docs) and any(want[d] != before[d] for d in near) and any("[SECRET]" in t for t in want.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in corpus_pipeline.run(spark, sf).collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == want.keys()
    for d, t in want.items():
        ids, at = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + r["length"]].tobytes())), d
            at += r["length"]
        assert at == len(ids)
    for v in by_sequence.values():
        assert [o for o, _ in sorted(v)] == np.cumsum([0, *(n for _, n in sorted(v))])[:-1].tolist() and sum(n for _, n in v) <= 1024


def test_near_copies_go_by_row(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, text + " x"), (2, "another text of its own"), (2, "another text of its own"), (None, text), (None, "alone"), (None, None), (3, None), (3, None), (4, "")]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, text), (2, "another text of its own"), (None, "alone"), (None, None), (3, None), (4, "")], key=str)


def test_pipeline_stages_on_awkward_rows(spark):
    import corpus_pipeline

    clashing = ("rid", "_rid", "RID_", "_kept", "cut", "stage", "teaches", "fold", "bundle", "low")
    docs = documents(spark, texts(7)).withColumns({c: F.concat(F.lit(c), F.coalesce("doc_id", F.lit(-1))) for c in clashing}).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "").cache()
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        assert all(r[c] == f"{c}{-1 if r['doc_id'] is None else r['doc_id']}" for r in after.collect() for c in clashing)
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").agg(F.count_distinct("doc_id")).first()[0] == docs.filter("doc_id is not null").select("doc_id").distinct().count()
    none = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0
