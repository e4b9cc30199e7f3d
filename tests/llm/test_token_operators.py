"""Filter audit, files of token ids, alignment of tokenizers."""

import hashlib
import os
import random
import re
import uuid
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tests.llm.helpers import DOCS, LABELS, documents, pairs, texts
from tests.oracle import duck_rows, spark_rows
from tokenizers import Tokenizer

from tidelog.llm import alignment, chunks, filter_audit, id_files
from tidelog.llm.queries import ORACLE_SQL, QUERIES
from tidelog.plans.storage import plain

WORDS, BYTES, PIECES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["</s> <|endoftext|> <|startoftext|>x", "a<|endoftext|>b", "x  y   z ", " lead", "tail ", "  ", " ", "a   b", "  x", "é é́ é", "≠ a̸", "ΑΣ ΑΣ. ΑΣ.Β Σa", "▁ ▁x", "ﬁ Ａ ①", "it's IT'S 'll x's.", "1,234.56 a1b2", "\r\n\r\n x\n\ny", "tab\t tab \t", "　  x  y", "🙂 🙂🙂 👩‍👩‍👧", "a\x00b \x1c c \x85 d", "".join(map(chr, range(1, 0x500)))]


# -- filter audit --------------------------------------------------------------------------------------------------


def test_popcounts():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 100, 1001):
        words = r.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        assert filter_audit.positional_popcount(words).tolist() == [int(((words >> np.uint32(i)) & 1).sum()) for i in range(32)]
    words = filter_audit.survival_words(np.arange(32), 5)
    assert all(bool(int(words[f]) >> s & 1) == (not f & s) for f in range(32) for s in range(32))


def brute_audit(docs, labels):
    """docs: (doc_id, text, source)."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    first, rows = {}, []
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, s in docs:
        t = t or ""
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        failed = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        rows.append((s or "", {k for k, v in failed.items() if v}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        for o in permutations("ABCDE"):
            for k, x in enumerate(o):
                before = set(o[:k])
                here = [r for r in own if x in r[1] and not r[1] & before]
                shapley[x] += len(here)
                out[part, "".join(o), k + 1] = [sum(not r[1] & (before | {x}) for r in own), len(here), sum(x in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {x} for r in own), sum(r[2] for r in here), sum(r[3] for r in here)]
        for (p, o, k), v in out.items():
            if p == part:
                v.append(shapley[o[k - 1]])
    return out


def audit_rows(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_filter_audit_equals_brute_force(spark):
    r = random.Random(3)
    found = texts() + [" ".join(f"w{i}" for i in range(60))] * 5 + ["A B " * 40, "x # y", "word " * 30]
    rows = [(i, t, "x", r.choice(["s1", "s2", None, ""]), None, "x", None, "y") for i, t in enumerate(found)]
    rows += [(3, found[5], "x", "s1", None, None, None, None), (None, found[0], None, "s1", None, None, None, None), (7, found[7], None, "s2", None, None, None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n", "part").withColumnRenamed("sid", "failed").repartition(3)
    done = filter_audit.audit_filters(docs, spark.createDataFrame(labels, LABELS))
    assert audit_rows(done) == brute_audit([(x[0], x[1], x[3]) for x in rows], labels)
    assert done.count() == 3 * 600


def test_filter_audit_without_rows(spark):
    assert filter_audit.audit_filters(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_filter_audit_of_long_texts_in_slices(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(30_000)) + " ABC#"
    whole = filter_audit.measured(text.encode())
    monkeypatch.setattr(filter_audit, "SLICE", 1000)
    assert filter_audit.measured(text.encode()) == whole == (30_001, 701, 3, True)
    assert filter_audit.measured(b"x" * 5000) == (1, 1, 0, False)


def test_filter_audit_query_equals_sql(spark, sf):
    assert spark_rows(QUERIES["op11_filter_audit"](spark, sf)) == duck_rows(ORACLE_SQL["op11_filter_audit"], sf)


# -- files of ids --------------------------------------------------------------------------------------------------


@pytest.fixture
def folder(spark):
    """A new folder; small partitions stay apart, so there are several files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/ids-{uuid.uuid4().hex}"
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def library_ids(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_give_ids_back(kind):
    r = np.random.default_rng(2)
    for ids in (np.zeros(5), np.array([]), np.array([1]), r.integers(0, 50_000, 1001), r.integers(0, 2**32, 77, dtype=np.uint64), np.array([2**32 - 1])):
        ids = ids.astype(np.uint32)
        planes = [p.tobytes() for p in id_files.to_planes(ids, kind)]
        assert id_files.from_planes(planes, len(ids), kind).tolist() == ids.tolist()


def test_chunks_encode_as_whole_texts():
    found = [t or "" for t in texts()] + ODD
    ids, counts = id_files.encode(pa.array([*found, None]), WORDS, 2)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library_ids(t) for t in [*found, ""]]


def test_words_and_marks_encode_as_whole_texts(spark, sf):
    """Every letter of the plain ones, before and after every mark, in both tokenizers; and whole texts of the table."""
    letters = [chr(c) for c in range(0x41, 0x180) if chr(c).isalpha()]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()] + ["×", "÷", "«", "»", "…"]
    found = [f"{x}{m}{y} a{x}{m}{m} {x}{m}\n{m}{x}" for x, m, y in zip(letters * 40, marks * len(letters), letters[::-1] * 40, strict=False)] + [" ".join(letters), "".join(letters)]
    found += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids, counts = id_files.encode(pa.array(found), WORDS, 2)
    t = Tokenizer.from_file(WORDS)
    assert [x.tolist()[:-1] for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in t.encode_batch(found, add_special_tokens=False)]
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    both = alignment.pair(BYTES, PIECES)
    cut = chunks.Chunked(pa.array(found), alignment._cuts, " ")
    known = both.remembered(cut.distinct.to_pylist())
    got = [np.frombuffer(b"".join(known[i][0] for i in cut.index[a:b]), np.int32).tolist() for a, b in zip(cut.first, cut.first[1:], strict=False)]
    assert got == [e.ids for e in t.encode_batch([" " + x for x in found], add_special_tokens=False)]


def test_random_strings_encode_as_whole_texts():
    r, letters = random.Random(5), ["a", "B", "s", "'", ".", ",", "!", " ", " ", "\n", "\t", "é", "́", "̸", "Σ", "σ", "<", "|", ">", "<|endoftext|>", "1", " ", " ", "ǅ", "İ", "字", "🙂", "‍"]
    found = ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(3000)]
    ids, counts = id_files.encode(pa.array(found), WORDS, 2)
    t = Tokenizer.from_file(WORDS)
    assert [x.tolist()[:-1] for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in t.encode_batch(found, add_special_tokens=False)]


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_files_hold_every_document_in_order(spark, folder, kind):
    docs = documents(spark, texts() + ODD)
    files = id_files.write_ids(docs, folder, WORDS, 2, id_files.Layout(block=256, planes=kind))
    assert files.count() > 1
    rows = sorted(id_files.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at, got = 0, []
    for r in rows:
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert (r["start"], r["n_tokens"]) == (at, len(own))
        got.append((r["doc_id"], own))
        at += len(own)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted([(i, library_ids(t)) for i, t in pairs(docs)], key=key)
    stream = [x for _, own in got for x in own]
    for first, n in ((0, 10), (250, 20), (at // 2, 1500), (at - 3, 100), (at, 5)):
        parts = sorted(id_files.read_range(spark, folder, first, n).collect(), key=lambda r: r["start"])
        assert [x for r in parts for x in np.frombuffer(r["ids"], "<u4").tolist()] == stream[first : first + n]


def test_a_damaged_block_is_an_error(spark, folder):
    id_files.write_ids(documents(spark), folder, WORDS, 2)
    name = id_files.files(spark, folder).first()["file"]
    with open(f"{plain(folder)}/{name}", "r+b") as f:
        f.seek(20)
        byte = f.read(1)
        f.seek(20)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged|zstd|[Dd]ecompress|[Dd]ata"):
        id_files.read_ids(spark, folder).collect()


def test_a_task_that_runs_again_leaves_the_same_files(spark, folder):
    docs = documents(spark)
    id_files.write_ids(docs, folder, WORDS, 2)
    again = f"{folder}-again"
    id_files.write_ids(docs.repartition(2), again, WORDS, 2)
    read = lambda f: sorted((r["doc_id"] or -1, r["start"], r["ids"]) for r in id_files.read_ids(spark, f).collect())
    assert read(folder) == read(again)
    assert not [x for x in os.listdir(plain(folder)) if x.startswith(".part")]


def test_no_documents_no_files(spark, folder):
    assert id_files.write_ids(spark.createDataFrame([], DOCS), folder, WORDS, 2).count() == 0
    assert id_files.read_ids(spark, folder).count() == 0


def test_id_query_equals_the_library(spark, sf):
    t, at, want = Tokenizer.from_file(WORDS), 0, []
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op12_id_planes"](spark, sf).collect()]
    assert sorted(got) == want


# -- alignment -----------------------------------------------------------------------------------------------------


def brute_alignment(rows):
    """(doc_id, text) rows; straight from the definition, token by token."""
    a_tok, b_tok = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_tok.encode_special_tokens = True
    letters = alignment.byte_alphabet()
    docs, counts = [], Counter()
    for i, text in rows:
        a = b = []
        if text:
            a = a_tok.encode(" " + text, add_special_tokens=False).ids
            b = b_tok.encode(text)
            bytes_a = [bytes(letters[c] for c in a_tok.id_to_token(x)) for x in a]
            bytes_b = [bytes([int(b_tok.id_to_piece(x)[3:5], 16)]) if b_tok.is_byte(x) else b_tok.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
                a = b = []
        links, groups = [], []
        if a:
            ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
            x = y = 0
            while x < len(a):
                if min(ends_a[x], ends_b[y]) > max(([0] + ends_a)[x], ([0] + ends_b)[y]):
                    links.append((a[x], b[y]))
                x, y = x + (ends_a[x] <= ends_b[y]), y + (ends_b[y] <= ends_a[x])
            low_a = low_b = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                high_a, high_b = ends_a.index(end) + 1, ends_b.index(end) + 1
                groups.append(",".join(map(str, a[low_a:high_a])) + "|" + ",".join(map(str, b[low_b:high_b])))
                low_a, low_b = high_a, high_b
        counts.update(links)
        docs.append((i, a, b, groups, links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [(i, len(a), len(b), len(g), len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, ls in docs]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_alignment_equals_brute_force(spark):
    docs = documents(spark, texts() + ODD).withColumnRenamed("n", "pairs").withColumnRenamed("sid", "bundle")
    want = sorted(brute_alignment(pairs(docs)), key=repr)
    assert aligned_rows(alignment.align_tokenizers(docs, BYTES, PIECES)) == want
    assert sum(w[1] > 0 for w in want) > 50 and sum(w[1] == 0 for w in want) >= 4


def test_alignment_in_small_bundles_and_pieces(spark, monkeypatch):
    """A document cut into pieces, and bundles of a document each, change nothing (bundles run here, not in workers)."""
    found = [t for t in texts(2) + ODD if t is not None]
    both = alignment.pair(BYTES, PIECES)
    ids = pa.array(range(len(found)), pa.int64())
    docs, totals = alignment.bundle(both, ids, pa.array(found))
    monkeypatch.setattr(alignment, "MOST_CHUNKS", 7)
    small, small_totals = alignment.bundle(both, ids, pa.array(found))
    plain = ["doc_id", *alignment.COUNTS, "groups_sha256"]
    assert docs.select(plain).equals(small.select(plain)) and totals.sort_by("pair").equals(small_totals.sort_by("pair"))
    linked = lambda t, total: [sorted(zip(total["pair"].take(pa.array(p, pa.int32())).to_pylist(), n, strict=True)) for p, n in zip(t["pairs"].to_pylist(), t["times"].to_pylist(), strict=True)]
    assert linked(docs, totals) == linked(small, small_totals)


def test_random_strings_align(spark):
    r, letters = random.Random(6), ["a", "the", "B", "'s", ".", "  ", " ", " ", "\n", "\t", "é", "́", " ", " ", "　", "<0x41>", "</s>", "<|endoftext|>", "1", "字", "🙂", "\x1c", "\x85"]
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 25)))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert aligned_rows(alignment.align_tokenizers(docs, BYTES, PIECES)) == sorted(brute_alignment(rows), key=repr)


def test_alignment_without_rows(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], DOCS), BYTES, PIECES).count() == 0


def test_alignment_query_equals_brute_force(spark, sf):
    rows = pairs(spark.read.parquet(f"{sf}/documents.parquet"))
    assert aligned_rows(QUERIES["op13_token_alignment"](spark, sf)) == sorted(brute_alignment(rows), key=repr)


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 30, 1, 1, 1, 9)] + [None]})
    found = list(chunks.slices(batch, "text", 10))
    assert [s.num_rows for s in found] == [2, 1, 3, 2] and pa.concat_arrays([s.column(0) for s in found]).equals(batch.column(0))
