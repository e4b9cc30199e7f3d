"""Registered queries opN_<name>: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import alignment, bpe, chat_format, filter_audit, fingerprints, id_files, language_id, ngram_join, packing, quality_model, quality_rules, secret_scan, suffix_dedup
from tidelog.llm.common import fold, table
from tidelog.plans.storage import shared_dir


def op1_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "passages")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), ngram_join.Join(words=3, percent=90))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), teaches=fold("doc_id", 4) != 2)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_summary(table(spark, sf_dir, "documents"), length=200).drop("begins", "ends")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(0, 2, 1, 1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    chats = chat_format.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    chats = chats.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("learned", chat_format.loss_text(F.col("segments")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        F.col("first_bad_turn").cast("bigint").alias("first_bad_turn"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    id_files.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return id_files.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_mil_quality, op2_ngram_jaccard, op3_language_id, op4_packing, op5_quality_rules, op6_suffix_dedup, op7_bpe, op8_order_minhash, op9_secret_scan, op10_chat_format, op11_filter_audit, op12_id_planes, op13_token_alignment)}

#: A mark inside a text gets one backslash, so it adds one character; the marks around a turn add theirs. The role
#: machine's language is a regular expression over the roles' initials; what it allows at all is a prefix of that.
ORACLE_SQL = {
    "op10_chat_format": r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select conv_id, turn, role, text,
    length(text) + len(regexp_extract_all(text, '(<\\*(s|/s)>|\[\\*(INST|/INST|SYS|/SYS|TOOL|/TOOL|TURN|/TURN|AS)\])'))
      + case role when 'system' then 11 when 'user' then 13 when 'assistant' then 7 when 'tool' then 13
        else 17 + length(role) + len(regexp_extract_all(role, '(<\\*(s|/s)>|\[\\*(INST|/INST|SYS|/SYS|TOOL|/TOOL|TURN|/TURN|AS)\])')) end as n,
    case when role in ('system', 'user', 'assistant', 'tool') then role[1] else 'x' end as r
  from c),
m as (select conv_id, string_agg(r, '' order by turn, role, text) as roles from e group by conv_id)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars,
  regexp_full_match(any_value(roles), 's?ua(t+a|ua)*') as valid,
  nullif(length(regexp_extract(any_value(roles), '^s?(u(a(t+a|ua)*(t+|u)?)?)?')), count(*)) as first_bad_turn
from e join m using (conv_id) group by conv_id""",
    "op11_filter_audit": r"""
with words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
firsts as (select text, min(doc_id) as first from words group by text),
failed as (
  select d.part, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 5 * length(d.text) as c,
    regexp_matches(d.text, '[#$%&*|]') as d, coalesce(d.doc_id > f.first, false) as e,
    coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
  from words d join firsts f using (text)
  left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) l on l.doc_id = d.doc_id),
kinds as (
  select part, [a, b, c, d, e] as f, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failed group by all),
steps as (
  select o as filter_order, i::int as step, list_position(['A', 'B', 'C', 'D', 'E'], o[i]) as x,
    [list_position(['A', 'B', 'C', 'D', 'E'], o[j]) for j in range(1, i)] as earlier
  from (select a || b || c || d || e as o from (values ('A'), ('B'), ('C'), ('D'), ('E')) t(a), (values ('A'), ('B'), ('C'), ('D'), ('E')) u(b),
      (values ('A'), ('B'), ('C'), ('D'), ('E')) v(c), (values ('A'), ('B'), ('C'), ('D'), ('E')) w(d), (values ('A'), ('B'), ('C'), ('D'), ('E')) y(e)
    where len(list_distinct([a, b, c, d, e])) = 5) orders, range(1, 6) t(i)),
seen as (
  select part, filter_order, step, x, f[x] as fails, coalesce(list_bool_or([f[y] for y in earlier]), false) as gone, list_sum([y::int for y in f]) as n_failed, n, good, toxic
  from kinds, steps),
report as (
  select part, filter_order, step, any_value(x) as x, coalesce(sum(n) filter (not gone and not fails), 0)::bigint as kept, coalesce(sum(n) filter (not gone and fails), 0)::bigint as removed,
    coalesce(sum(n) filter (gone and fails), 0)::bigint as redundant, coalesce(sum(n) filter (fails and n_failed = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (not gone and fails), 0)::bigint as good_lost, coalesce(sum(toxic) filter (not gone and fails), 0)::bigint as toxic_lost
  from seen group by part, filter_order, step)
select * exclude (x), sum(removed) over (partition by part, x)::bigint as shapley from report""",
}
