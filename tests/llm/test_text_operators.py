import base64
import hashlib
import json
import os
import random
import re
import textwrap
import time
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tests.llm.helpers import DOCS, LABELS, documents, pairs
from tokenizers import Tokenizer

from tidelog.llm import bpe, fingerprints, language_id, packing, quality_model, quality_rules, secret_scan

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FIFTY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_bpe_equals_library_and_round_trips(docs, none):
    library = tiktoken.Encoding(name="t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(MULTI), special_tokens={})
    found = bpe.decode(bpe.encode(docs, MULTI, public_tokenizers.PATTERN, chunk_chars=500), MULTI, public_tokenizers.PATTERN).collect()
    want = Counter((d, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for d, t in pairs(docs))
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["data"])) for r in found) == want
    assert bpe.encode(none, MULTI, public_tokenizers.PATTERN).count() == 0


def test_long_words_one_by_one_equal_library():
    library = tiktoken.Encoding(name="t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(MULTI), special_tokens={})
    replay, r = bpe.MergeReplay(bpe.load_ranks(MULTI)), random.Random(6)
    for letters, n in (("a", 7), ("a", 30_001), ("ab", 60_000), ("théionsrgé", 60_000), ("abcdefghijklmnopqrstuvwxyz", 300)):
        word = "".join(r.choice(letters) for _ in range(n)).encode()
        assert replay.one(replay.byte_ids[np.frombuffer(word, np.uint8)].tolist()) == library._core_bpe.encode_single_piece(word)
        assert np.frombuffer(replay.encode([word])[0], "<u4").tolist() == library._core_bpe.encode_single_piece(word)


def test_packing_covers_every_id_once(docs, none):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(docs, FIFTY, public_tokenizers.PATTERN, window=64, max_gap=8, keep_ids=True).collect()
    want = Counter()
    for d, t in pairs(docs):
        want[(d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0]))] += 1
    by_doc, by_sequence = {}, {}
    for r in found:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in found) == sum(len(ids) * n for (_, ids), n in want.items())
    singles = {k: v for k, v in by_doc.items() if sum(n for (d, ids), n in want.items() if d == k[0]) == 1}
    assert all((d, tuple(x for _, ids in sorted(v) for x in ids)) in want for (d, _), v in singles.items())
    for v in by_sequence.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, FIFTY, public_tokenizers.PATTERN).count() == 0


def test_packing_query_of_a_real_table(spark, sf):
    from tidelog.llm.queries import QUERIES

    tokenizer, by_doc, by_sequence, total = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}, {}, 0
    for r in QUERIES["op4_packing"](spark, sf).collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, t in pairs(spark.read.parquet(f"{sf}/documents.parquet")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total, at = total + len(ids), 0
        for r in sorted(by_doc.pop(d), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + r["length"]].tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for v in by_sequence.values():
        assert [o for o, _ in sorted(v)] == np.cumsum([0, *(n for _, n in sorted(v))])[:-1].tolist() and sum(n for _, n in v) <= 1024
    assert len(by_sequence) <= 1.01 * total / 1024 + 1


def test_best_fit_is_item_by_item_best_fit():
    r = np.random.default_rng(5)
    for _ in range(20):
        sizes = r.integers(1, 50, r.integers(1, 300)).tolist()
        rooms = []
        for s in sorted(sizes, reverse=True):
            fit = [i for i, x in enumerate(rooms) if x >= s]
            if fit:
                rooms[min(fit, key=rooms.__getitem__)] -= s
            else:
                rooms.append(50 - s)
        placed, runs, n = packing.best_fit(dict(Counter(sizes)), 50)
        assert n == len(rooms) == sum(x[1] for x in runs) and sum(p[2] for p in placed) == len(sizes)
        assert Counter(50 - x for x in rooms) == Counter({f: 0 for *_, f in runs}) + Counter(f for _, k, f in runs for _ in range(k))


def test_rule_counts(docs, none, spark):
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(40)] + [(1, 0, 0), (None, 1, None)], LABELS)
    found = quality_rules.apply_rules(docs, labels).collect()
    assert len(found) == docs.count()
    want = Counter()
    for d, t in pairs(docs):
        w = WORD.findall(t or "")
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        want[(d, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), failed)] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found) == want
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert quality_rules.apply_rules(none, labels).count() == 0


def test_cutoffs_hold_the_risk():
    assert abs(quality_rules.binomial_tail(2, 10, 0.3) - sum(__import__("math").comb(10, k) * 0.3**k * 0.7 ** (10 - k) for k in range(3))) < 1e-12
    n = len(quality_rules.CUTOFFS)
    assert quality_rules.certified_cutoff([0] * n, [9] * n, 50, 0.01, 0.05) is None  # too few documents
    c = quality_rules.certified_cutoff([0] * 10 + [500] * (n - 10), [9] * 5 + [20] * (n - 5), 5000, 0.01, 0.05)
    assert c == quality_rules.CUTOFFS[5]


def rule_texts(n, seed):
    """(id, text, stratum, quality): good texts, of which few look odd, and bad ones with symbols, capitals or repeated lines."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        w, bad, odd = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(40)], r.random() < 0.2, r.random()
        if bad and odd < 0.4 or not bad and odd < 0.002:
            w = [x + "#$" for x in w]
        elif bad and odd < 0.6 or not bad and odd < 0.05:
            w = [x.upper() for x in w]
        elif bad and odd < 0.8 or not bad and odd < 0.052:
            w += ["\nsame line"] * 6 + ["\n"]
        out.append((i, " ".join(w), ("x", "y", None)[min(i % 8, 2)], int(not bad)))
    return out


def brute_cutoffs(rows, rates, risk, level):
    """Proposals of one fold, tested in sequence by the rest."""
    paths, strata = {}, {s for _, _, s, _ in rows}
    for s in strata:
        own = [(rates[i], q) for i, _, of, q in rows if of == s and zlib.crc32(str(i).encode()) % 4 == 0]
        path = []
        for k, rule in enumerate(quality_rules.RULES):
            best = None
            for c in quality_rules.CUTOFFS:
                good, bad = (sum(x[rule] > c for x, q in own if q == want) for want in (1, 0))
                if good > risk * sum(q for _, q in own):
                    break
                if bad > good and (best is None or bad - good > best[0]):
                    best = (bad - good, good, c)
            if best:
                path.append((best[1], -best[0], k, rule, best[2]))
        if path:
            paths[s] = [x[3:] for x in sorted(path)]
    out = {}
    for s, path in paths.items():
        own = [rates[i] for i, _, of, q in rows if of == s and q and zlib.crc32(str(i).encode()) % 4]
        for k in range(len(path)):
            hit = sum(any(x[rule] > c for rule, c in path[: k + 1]) for x in own)
            if sum(__import__("math").comb(len(own), j) * risk**j * (1 - risk) ** (len(own) - j) for j in range(hit + 1)) > level / len(paths):
                break
            out.setdefault(s, {})[path[k][0]] = path[k][1]
    return out


def test_verdicts_equal_brute_force_and_hold_on_unseen_texts(spark):
    rows, unseen = rule_texts(4000, 1), rule_texts(4000, 2)
    schema = "doc_id bigint, text string, lang string, quality int"
    df = spark.createDataFrame([*rows, *((10_000 + i, *x) for i, *x in unseen)], schema).repartition(3)
    found = {r["doc_id"]: r for r in quality_rules.apply_rules(df, df.filter("doc_id < 10000").select("doc_id", "quality")).collect()}
    rates = {}
    for i, t, _, _ in rows + [(10_000 + i, *x) for i, *x in unseen]:
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        assert not found[i]["base_failed"]
        chars = sum(map(len, w))
        rates[i] = {"symbols": min(1.0, sum(t.count(c) for c in "#*$%&|<>") / chars), "dup_lines": (len(lines) - len(set(lines))) / len(lines), "repeats": found[i]["n_repeat_words"] / len(w), "upper": sum("A" <= c <= "Z" for c in t) / chars, "marks": 0.0}
    cutoffs = brute_cutoffs(rows, rates, 0.02, 0.05)
    assert {"symbols", "dup_lines"} <= set(cutoffs[None]) and "upper" not in cutoffs[None]
    strata = {i: s for i, _, s, _ in rows} | {10_000 + i: s for i, _, s, _ in unseen}
    for i, r in found.items():
        want = [rule for rule in quality_rules.RULES if rates[i][rule] > cutoffs.get(strata[i], {}).get(rule, 9)]
        assert r["failed_rules"] == want and r["kept"] == (not want)
    for s in ("x", "y", None):
        good = [found[10_000 + i]["kept"] for i, _, of, q in unseen if of == s and q]
        assert good.count(False) <= 0.02 * len(good)
    assert not all(found[10_000 + i]["kept"] for i, _, _, q in unseen if not q)


def test_secrets(spark, docs, none):
    header = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).rstrip(b"=").decode()
    number = lambda n: b"\x02" + bytes([n]) + bytes([7]) * n
    body = b"".join([number(1), number(20), number(3), *[number(12)] * 6])
    der = base64.b64encode(b"\x30\x81" + bytes([len(body)]) + body).decode() if len(body) > 127 else base64.b64encode(b"\x30" + bytes([len(body)]) + body).decode()
    openssh = base64.b64encode(b"openssh-key-v1\0" + b"\0\0\0\4none" * 2 + b"\0\0\0\0" + b"\0\0\0\1" + b"x" * 20).decode()
    text = f"é password = hunter22 AKIA{'A' * 16} {'0a' * 12} {header}.abcd.sig {der} {openssh} token: short"
    kinds = [k for _, _, k in secret_scan.find_spans(text)]
    assert kinds == ["assign", "access", "hex", "jwt", "der", "openssh"]
    assert [k for _, _, k in secret_scan.find_spans("eyJub3QiOjF9eyJub3Q.abcd.x MIIB" + "A" * 40)] == []
    assert secret_scan.base_spans("token: token=abcdefg")[0] == (0, 20, "assign") and secret_scan.base_spans("ſecret=abcdef") == []
    rows = secret_scan.scan_secrets(docs).collect()
    assert len(rows) == docs.count() and secret_scan.scan_secrets(none).count() == 0
    clean = secret_scan.redact_secrets(spark.createDataFrame([(1, text, None, None, len(text), None, None, None), (2, None, None, None, None, None, None, None)], DOCS)).orderBy("doc_id").collect()
    assert clean[0]["text"] == "é [SECRET] [SECRET] [SECRET] [SECRET] [SECRET] [SECRET] token: short" and clean[0]["n_chars"] == len(clean[0]["text"]) and clean[1]["text"] is None


def test_scan_finds_what_a_look_at_every_text_finds(spark, sf, docs):
    token = lambda head: base64.urlsafe_b64encode(head.encode()).rstrip(b"=").decode() + ".abcd."
    odd = ['{ "alg":"none" }', '{"alg":"none"}', ' {"alg":""}', '\n{"typ":"JWT","alg":"HS256"}', '{"typ":"JWT"}']
    every = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(spark.createDataFrame([(-1 - i, "a " + token(t)) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    got = Counter((r["doc_id"], tuple((s["start"], s["end"], s["kind"]) for s in r["spans"])) for r in secret_scan.scan_secrets(every).collect())
    assert got == Counter((d, tuple(secret_scan.find_spans(t or ""))) for d, t in pairs(every))
    assert [bool(s) for d, s in sorted(got, key=str) if d is not None and d < 0] == [True, True, True, True, False]


def plain_base(text):
    """The base spans, by the words of the contract."""
    out = []
    for kind, pattern, group, least in (("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_a_plain_scan(spark, sf):
    from tidelog.llm.queries import QUERIES

    want = {d: hashlib.sha256(plain_base(t or "").encode()).hexdigest() for d, t in pairs(spark.read.parquet(f"{sf}/documents.parquet"))}
    assert {r["doc_id"]: r["base_sha256"] for r in QUERIES["op9_secret_scan"](spark, sf).collect()} == want


def test_keys_in_armour_of_every_length(spark):
    def der(size):
        """size bytes that are built as a PKCS#1 key."""
        body = size - 4
        numbers = [b"\x02\x01\x00", *[b"\x02\x0c" + bytes(range(1, 13))] * 7]
        last = body - sum(map(len, numbers)) - 4
        return b"\x30\x82" + body.to_bytes(2, "big") + b"".join(numbers) + b"\x02\x82" + last.to_bytes(2, "big") + b"\x05" * last

    for size in (400, 401, 402):
        key = base64.b64encode(der(size)).decode()
        assert len(der(size)) == size
        for width, breaks in ((64, "\n"), (64, "\r\n"), (76, "\n"), (len(key), "\n")):
            lines = breaks.join(key[i : i + width] for i in range(0, len(key), width))
            for before, after in (("-----BEGIN RSA PRIVATE KEY-----" + breaks, breaks + "-----END RSA PRIVATE KEY-----" + breaks), ("", breaks + "word and more"), ("ab" * 20 + breaks, "\nwords\n"), ("", "-----END")):
                text = before + lines + after
                assert (len(before), len(before + lines), "der") in secret_scan.find_spans(text), (size, width, before, after)
                clean = secret_scan.redact_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["text"] if width == 64 and before[:1] == "-" else None
                assert clean is None or clean == before + "[SECRET]" + after
    block = lambda b: len(b).to_bytes(4, "big") + b
    for n in (90, 91, 92):
        key = base64.b64encode(b"openssh-key-v1\0" + block(b"none") * 2 + block(b"") + b"\0\0\0\1" + block(b"p" * 33) + block(b"s" * n)).decode()
        assert (0, len(key), "openssh") in secret_scan.find_spans(key + "\nword")
    assert (0, 800, "der") in secret_scan.find_spans(der(400).hex() + "abcdef0123")


def test_keys_in_the_layouts_of_other_formats(spark):
    numbers = [b"\x02\x01\x00", *[b"\x02\x0c" + bytes(range(1, 13))] * 7]
    last = 396 - sum(map(len, numbers)) - 4
    key = b"\x30\x82" + (396).to_bytes(2, "big") + b"".join(numbers) + b"\x02\x82" + last.to_bytes(2, "big") + b"\x05" * last
    lines = textwrap.wrap(base64.b64encode(key).decode(), 64)
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    layouts = {
        "json": (f'{{"private_key": "{begin}\\n', "\\n", f'\\n{end}\\n"}}'),
        "json in json": (f'\\"{begin}\\\\n', "\\\\n", f'\\\\n{end}'),
        "written out CRLF": (f"{begin}\\r\\n", "\\r\\n", f"\\r\\n{end}"),
        "yaml": (f"key: |\n    {begin}\n    ", "\n    ", f"\n    {end}\n"),
        "mail": (f"> {begin}\n> ", "\n> ", f"\n> {end}\n"),
        "blank at the line end": (f"{begin} \n", " \n", f" \n{end}"),
        "code": ('"', '" +\n    "', '";'),
        "comment": (f"# {begin}\n# ", "\n# ", f"\n# {end}"),
        "name": ("api-key_", "", " and"),
        "path": ("data/", "", ""),
        "number": ("0123456789" * 4, "\n", ""),
    }
    rows, want = [], {}
    for i, (name, (before, between, after)) in enumerate(layouts.items()):
        text = before + between.join(lines) + after
        assert (len(before), len(text) - len(after), "der") in secret_scan.find_spans(text), name
        rows.append((i, text))
        want[i] = before + "[SECRET]" + after
    for digit in ("", "a", "ab", "3"):
        assert (len(digit), len(digit) + 800, "der") in secret_scan.find_spans(digit + key.hex()), digit
        assert (len(digit), len(digit) + 800, "der") in secret_scan.find_spans(digit + key.hex().upper() + "abc"), digit
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: t for i, t in clean.items() if not rows[i][1].startswith("0123")} == {i: t for i, t in want.items() if not rows[i][1].startswith("0123")}
    long = base64.b64encode(b"\x30\x83\x02\x00\x00\x02\x01\x00\x02\x0c" + b"x" * 20).decode()
    began = time.perf_counter()
    assert [s for s in secret_scan.find_spans(long * 20_000) if s[2] == "der"] == []
    assert time.perf_counter() - began < 20  # candidates that claim great lengths aren't decoded whole


def brute_order_minhash(text):
    """Straight from the definition, with plain integers."""
    mask, golden = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def mix(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> shift)) * factor & mask
        return x

    k = min(8, len(text))
    seen, bins = Counter(), {}
    for at in range(len(text) - k + 1 if text else 0):
        h = 0
        for c in text[at : at + k]:
            h = (h * golden + ord(c)) & mask
        kmer = mix((h + k) & mask) >> 20
        rank = mix((kmer + seen[kmer] * golden) & mask)
        seen[kmer] += 1
        bins.setdefault(rank >> 57, []).append((rank, at, kmer))
    out = [0] * 128
    for b, found in bins.items():
        t = 0
        for j, (_, _, kmer) in enumerate(sorted(sorted(found)[:2], key=lambda x: x[1])):
            t = mix((t * golden + kmer + j + 1) & mask)
        out[b] = t % 65535 + 1
    return out


def brute_likeness(a, b):
    """Equal components over those that either text has."""
    either = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in either) / len(either) if either else 1.0


def test_fingerprints_equal_brute_force(docs):
    for _, t in pairs(docs):
        assert fingerprints.fingerprint(t or "").tolist() == brute_order_minhash(t or "")


def test_long_text_resembles_its_half():
    text = np.random.default_rng(1).integers(97, 123, (1 << 20) + 100, np.uint8).tobytes().decode()
    whole, half = fingerprints.fingerprint(text), fingerprints.fingerprint(text[: len(text) // 2])
    assert fingerprints.likeness(whole, half) > 0.1
    assert fingerprints.likeness(whole, fingerprints.fingerprint(text[: 1 << 20])) > 0.9


def test_fingerprints_and_edits(docs, none, spark):
    found = fingerprints.fingerprint_edits(docs).collect()
    assert len(found) == docs.count()
    order = sorted(((-(1 << 63) if d is None else d, t or "", d) for d, t in pairs(docs)), key=lambda x: (-x[0], x[1]))
    want, brute = Counter(), cache(brute_order_minhash)
    for i, (_, t, d) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        prints = ["".join(f"{x:04x}" for x in brute(x)) for x in (t, edited)]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *prints, brute_likeness(brute(t), brute(edited)), brute_likeness(brute(t), brute(nxt)))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")) for r in found) == want
    by_text = {}
    for d, t in pairs(docs):
        if d is not None:
            by_text.setdefault(t or "", set()).update(r["fingerprint"] for r in found if r["doc_id"] == d)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints.fingerprint_edits(none).count() == 0
    a, b = "the quick brown fox jumps over the lazy dog " * 3 + "one two three four five six", "completely other words in this other text, nothing alike " * 3
    assert fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(a[:-3] + "sex")) > 0.5 > fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b))


def test_frequent_ids_are_many_stretches(spark):
    r = random.Random(8)
    rows = [(None, "".join(r.choice("aé漢\U0001F600z") for _ in range(r.randint(0, 12)))) for _ in range(300)] + [(1 << 60, f"t{i}") for i in range(200)] + [((1 << 60) + i % 3, "x") for i in range(9)] + [(i, f"own {i}") for i in range(200)] + [(None, None)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spread = fingerprints.with_neighbours(df).cache()
    assert spread.filter("doc_id is null and not guest").select("stretch").distinct().count() > 3
    assert spread.filter("guest").count() < len(rows) / 4
    order = sorted(((-(1 << 63) if d is None else d, t or "", d) for d, t in rows), key=lambda x: (-x[0], x[1]))
    want = Counter()
    for i, (_, t, d) in enumerate(order):
        half = len(t) // 2
        want[(d, hashlib.sha256((t[: len(t) - half] + order[(i + 1) % len(order)][1][:half]).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in fingerprints.fingerprint_edits(df).collect()) == want


def test_languages(spark, sf, docs, none):
    found = spark.read.parquet(f"{sf}/documents.parquet")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    got = language_id.identify(found, teaches=~held).join(found.select("doc_id", "lang"), "doc_id").filter(held)
    assert got.filter("lang = lang_pred").count() >= 0.9 * got.count()
    odd = language_id.identify(docs).collect()
    assert len(odd) == docs.count()
    blank = {d for d, t in pairs(docs) if d is not None and not any(c.isalpha() for c in t or "")}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in blank) and 0 <= r["score"] <= 1 for r in odd if r["doc_id"] is not None)
    assert language_id.identify(none).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_no_language_is_rejected_though_it_taught(spark, sf):
    import corpus_pipeline

    r = random.Random(3)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 9)))
    odd = [" ".join(word("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (30, 100, 400)] + [" ".join(word("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(n)) for n in (30, 100, 400)]
    clean = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    planted = clean.unionByName(spark.createDataFrame([(-1 - i, t, ("en", "de", "fr")[i % 3]) for i, t in enumerate(odd)], clean.schema))
    kept = corpus_pipeline.keep_known_languages(spark, planted, sf)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in clean.collect()}
    got = language_id.identify(planted, teaches=F.col("doc_id") % 4 != 2).filter("doc_id < 0 or rejected").collect()
    assert {r["doc_id"] for r in got} == {-1 - i for i in range(len(odd))} and all(r["rejected"] for r in got)


@pytest.mark.parametrize("rate", [0.1, 0.2, 0.4])
def test_rejections_of_unseen_texts_keep_their_rate(spark, rate):
    """Without any slack a rejection is up to the rate alone: texts that taught nothing and set nothing are rejected about so often."""
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taught = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 < 2
    n, rejected = language_id.identify(found, teaches=taught, slack=-100.0, rate=rate).join(found.filter(~taught).select("doc_id"), "doc_id").filter("entropy is not null").agg(F.count("*"), F.count_if("rejected")).first()
    margin = 3.5 * (rate * (1 - rate) * 2 / n) ** 0.5  # the limit itself is drawn from about half as many texts
    assert n > 400 and rate - 2 * margin < rejected / n < rate + margin
    clean = language_id.identify(found, teaches=taught, rate=rate).filter("rejected and entropy is not null")
    assert clean.count() == 0


def test_room_is_the_excess_of_its_rank(spark):
    r = random.Random(9)
    rows = [(lang, True, False, r.gauss(0, 1)) for lang, n in (("a", 400), ("b", 99), ("c", 30)) for _ in range(n)] + [("a", True, True, 90.0), ("a", False, False, 99.0), (None, True, False, None)]
    schema = "lang_best string, teaches boolean, sets boolean, excess double"
    room = lambda rows, slack, rate: {x["lang_best"]: x["room"] for x in language_id.rooms(spark.createDataFrame(rows, schema), ["a", "b", "c", "d"], slack, rate).collect()}
    own, every = sorted(x[3] for x in rows[:400]), sorted(x[3] for x in rows[:529])
    got = room(rows, -9.0, 0.1)
    rank = lambda n: -(-(n + 1) * 9 // 10)
    assert own[rank(400) - 1] <= got["a"] <= own[rank(400) + 2] and got["b"] == got["c"] == got["d"]
    assert every[rank(529) - 1] <= got["b"] <= every[rank(529) + 2]
    assert set(room(rows, 5.0, 0.1).values()) == {5.0}
    assert set(room(rows[:8], 0.0, 0.1).values()) == set(room([rows[-1]], 0.0, 0.1).values()) == {float("inf")}


def units(text):
    """What the language models see: lower-case letters and single blanks, led by three marks."""
    out = []
    for c in text.replace("\0", " "):
        x = (c.lower()[0] if ord(c) < 1 << 16 else c) if c.isalpha() else " "
        if x != " " or not out or out[-1] != " ":
            out += np.frombuffer(x.encode("utf-16-le"), np.uint16).tolist() if x != " " else [" "]
    return [0, 0, 0, *out] if any(x != " " for x in out) else []


def brute_kneser_ney(texts, n_symbols):
    """Log-probability of a 4-gram, straight from the definition."""
    counts = {4: Counter(tuple(u[i : i + 4]) for u in map(units, texts) for i in range(len(u) - 3))}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(g):
        n = len(g)
        if not n:
            return 1 / (n_symbols + 1)
        ones, twos = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones else 0.5
        after = [c for h, c in counts[n].items() if h[:-1] == g[:-1]]
        return (max(counts[n][g] - d, 0) + d * len(after) * p(g[1:])) / sum(after) if after else p(g[1:])

    return p


def test_language_models_equal_brute_force(spark):
    r = random.Random(4)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(1, 5)))
    taught = [(lang, fold, " ".join(word(x) for _ in range(60))) for fold in (0, 1) for lang, x in (("x", "abcdE"), ("y", "cdéf\U00010414"))] + [("x", 0, "A1b\0 \U0001F600 c"), ("y", 1, "?!"), ("z", 0, "αβγ γα"), ("w", 1, "12")]
    df = spark.createDataFrame(taught, "lang string, fold int, text string").repartition(3)
    langs, table, unseen = language_id.model_table(language_id.count_ngrams(df, ["w", "x", "y", "z"]), ["w", "x", "y", "z"])
    assert langs == ["x", "y", "z"]
    model = language_id.Model.of(table.toArrow(), langs, unseen)
    asked = ["abc dec", "éff zé", "γα ab", "\U00010414c", "q"]
    n_symbols = len({g[3] for _, _, t in taught for u in [units(t)] for g in zip(u, u[1:], u[2:], u[3:], strict=False)})
    for half in (0, 1):
        got, sizes = model.sums(half, asked)
        for j, lang in enumerate(langs):
            own = [t for of, fold, t in taught if of == lang and (fold == half or lang == "z")]
            p = brute_kneser_ney(own, n_symbols)
            for i, t in enumerate(asked):
                u = units(t)
                assert sizes[i] == len(u) - 3
                assert got[i, j] == pytest.approx(sum(np.log(p(tuple(u[k : k + 4]))) for k in range(len(u) - 3)), rel=1e-4)
    symbols = {u for _, _, t in taught for u in units(t)} - {0}
    p = brute_kneser_ney([t for of, fold, t in taught if of == "x" and fold == 0], n_symbols)
    assert sum(p((0, 97, 98, u)) for u in symbols) + p((0, 97, 98, "never")) == pytest.approx(1)


def test_languages_do_not_depend_on_partitions_or_the_way_of_scoring(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = lambda df: Counter((r["doc_id"], r["lang_pred"], round(r["score"], 6), r["rejected"], r["n_symbols"], None if r["entropy"] is None else round(r["entropy"], 6)) for r in df.collect())
    taught = F.col("doc_id") % 4 != 2
    want = rows(language_id.identify(docs.repartition(3), teaches=taught))
    assert rows(language_id.identify(docs.repartition(7), teaches=taught)) == want
    joined = rows(language_id.identify(docs, teaches=taught, most_model=0))
    key = lambda x: tuple(map(str, (*x[:2], x[4], x[2])))
    for x, y in zip(sorted(joined.elements(), key=key), sorted(want.elements(), key=key), strict=True):
        assert x[:2] + x[3:5] == y[:2] + y[3:5] and x[2] == pytest.approx(y[2], abs=2e-6) and x[5] == pytest.approx(y[5], abs=2e-6)


def test_long_texts_are_cut_into_pieces():
    text = " ".join(random.Random(5).choice(["ab", "c1", "  ", "é"]) for _ in range(200_000))
    texts = ["a b", text, None, "?", text[: language_id.CHUNK], "z"]
    s, begins, sizes = language_id.stream(texts)
    assert [s[b : b + n].tolist() for b, n in zip(begins, sizes, strict=True)] == [[32 if x == " " else x for x in units(t or "")[3:]] for t in texts]


def test_quality_model(spark, sf, docs, none):
    found, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_model.score_quality(found, labels).join(labels, "doc_id").collect()
    good, bad = [r["score"] for r in got if r["quality"]], [r["score"] for r in got if not r["quality"]]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9
    odd = quality_model.score_quality(docs, labels.limit(0)).collect()
    assert len(odd) == docs.count() and {r["score"] for r in odd} == {0.5}
    assert quality_model.score_quality(none, labels).count() == 0


def test_quality_of_labels_that_nothing_was_learned_from(spark, sf):
    from tidelog.llm.queries import QUERIES

    sf = os.path.join(os.path.dirname(sf), "sf0.01") if os.path.isdir(os.path.join(os.path.dirname(sf), "sf0.01")) else sf
    got = QUERIES["op1_mil_quality"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r["score"] for r in got if r["quality"]], [r["score"] for r in got if not r["quality"]]
    assert len(good) > 3 < len(bad) and np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good]) > 0.95


def test_attention_gradient_equals_differences():
    r = np.random.default_rng(1)
    bags, y = [r.normal(size=(k, 5)).astype(np.float32) for k in (1, 3, 4, 2)], np.array([0.0, 1, 1, 0])
    model = quality_model.train(bags, y, rounds=3)
    x, begins = np.concatenate(bags).astype(np.float64), np.array([0, 1, 4, 8])
    loss = lambda: -np.mean(np.where(y > 0, np.log(p := model.forward(x, begins)["p"]), np.log(1 - p)))
    for name, g in model.gradient(x, begins, y).items():
        w = np.atleast_1d(model.w[name])
        for at in list(np.ndindex(w.shape))[::7]:
            both = []
            for step in (1e-6, -1e-6):
                moved = w.copy()
                moved[at] += step
                model.w[name] = moved.reshape(np.shape(model.w[name]))
                both.append(loss())
            model.w[name] = w.reshape(np.shape(model.w[name]))
            assert (both[0] - both[1]) / 2e-6 == pytest.approx(np.atleast_1d(g)[at], abs=1e-6)


def test_attention_gradient():
    r = np.random.default_rng(0)
    bags, y = [r.normal(size=(k, 5)).astype(np.float32) for k in (1, 3, 4, 2)], np.array([0.0, 1, 1, 0])
    model = quality_model.train(bags, y, rounds=200)
    assert ((model.score(bags) > 0.5) == (y > 0)).all()
