"""The registered queries of this subpackage and, where SQL can say it, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import archives, decontaminate, licences, mixing, periodic_runs, prefix_trie, quality_model, quality_rules, secrets, simhash, substrings, suffix_merge, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# One window of an item is its ten words from some word on, or the whole of a shorter item.
ORACLES["op10_decontamination"] = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark),
win as (select distinct item, list_slice(w, i, i + least(len(w), 10) - 1) as g
        from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct len(g) as n from win),
grams as (select r, n, i, list_slice(w, i, i + n - 1) as g from
          (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hit as (select r, n, i, item from grams join win using (g)),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct r, item from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(_table(spark, sf_dir, "documents")).drop("spans", "factors")


# Spans and factors are left out of the SQL; the kept words imply the former, tests hold the latter against a brute-force parse.
ORACLES["op2_substrings"] = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select r, doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) as g
        from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
least as (select g, min(doc_id) as ref from win group by g),
gone as (select r, list(distinct p) as ps from (select r, unnest(range(i, i + 50)) as p from win join least using (g)
         where coalesce(doc_id, 9223372036854775807) > coalesce(ref, 9223372036854775807)) group by r),
kept as (select r, list_filter(list_transform(w, lambda x, i: case when list_contains(ps, i) then null else x end), lambda x: x is not null) as k
         from d join gone using (r))
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed,
       sha256(array_to_string(case when ps is null then w else k end, ' ')) as kept_sha256
from d left join gone using (r) left join kept using (r)
"""


@_query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = token_files.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(stored)


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_table(spark, sf_dir, "documents"))


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def _quality_rules_sql() -> str:
    names = ["symbols", "dup_lines", "repeat_words", "long_words", "short_words"]
    cells = " union all ".join(f"select lang, source, '{m}' as measure, {m} as x from measured" for m in names)
    levels = {"f": "lang, source, measure", "l": "lang, measure", "w": "measure"}
    quantiles = ", ".join(
        f"""{k} as (select {by}, max(total) as docs, min(case when 4 * upto >= total then b end) as q1,
            min(case when 4 * upto >= 2 * total then b end) as q2, min(case when 4 * upto >= 3 * total then b end) as q3
            from (select {by}, b, sum(n) over (partition by {by} order by b) as upto, sum(n) over (partition by {by}) as total
                  from (select {by}, b, count(*) as n from cells group by {by}, b)) group by {by})""" for k, by in levels.items())
    pick = {q: f"case when f.docs >= {quality_rules.LEAST_DOCS} then f.{q} when l.docs >= {quality_rules.LEAST_DOCS} then l.{q} else w.{q} end" for q in ("q1", "q2", "q3")}
    limits = []
    for measure, side, floor in quality_rules.MEASURES:
        spread = f"{pick['q2']} - {pick['q1']}" if side > 0 else f"{pick['q3']} - {pick['q2']}"
        limits.append(f"max(case when f.measure = '{measure}' then {pick['q2']} + {side * quality_rules.REACH} * greatest({spread}, {floor}) end) as limit_{measure}")
    good = " and ".join(f"{m} {'<=' if side > 0 else '>='} limit_{m}" for m, side, _ in quality_rules.MEASURES)
    return rf"""
    with d as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
    w as materialized (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, list_filter(string_split(t, chr(10)),
          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
    runs as (select r, i, hash(list_slice(ws, i, i + 7)) as h from (select r, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
    twice as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from
              (select r, i, count(*) over (partition by r, h) as c from runs) where c > 1) group by r),
    base as (select w.r, doc_id, lang, source, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
             cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, len(ls) as n_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words
             from w left join twice using (r)),
    measured as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
             coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) as symbols, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) as dup_lines,
             coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) as repeat_words, coalesce(1000 * word_chars // nullif(n_words, 0), 0) as long_words,
             coalesce(1000 * word_chars // nullif(n_words, 0), 0) as short_words from base),
    cells as (select lang, source, measure, x - x % cast(pow(2, greatest(length(bin(x)) - 7, 0)) as bigint) as b from ({cells})),
    {quantiles.replace(" w as (", " whole as (")},
    limits as (select f.lang, f.source, {", ".join(limits)} from f join l on f.lang is not distinct from l.lang and f.measure = l.measure
               join whole as w on f.measure = w.measure group by f.lang, f.source)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {good} as kept
    from measured m join limits on m.lang is not distinct from limits.lang and m.source is not distinct from limits.source
    """


ORACLES["op9_quality_rules"] = _quality_rules_sql()


@_query
def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_model.fit_quality(documents, _table(spark, sf_dir, "labels"))
    return quality_model.score_quality(documents.select("doc_id", "text"), model).drop("text")


@_query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


@_query
def op4_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archived_pages(_table(spark, sf_dir, "pages"))


# Of rows with equal page_id and payload one is the response, the others revisit it.
ORACLES["op4_archives"] = """
select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest,
       case when again then 'revisit' else 'response' end as record_type, case when again then first_page end as refers_to
from (select *, strlen(coalesce(html, '')) >= 100 and row_number() over (partition by coalesce(html, '') order by page_id nulls last) > 1 as again,
             min(page_id) over (partition by coalesce(html, '')) as first_page from pages)
"""


@_query
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(_table(spark, sf_dir, "documents"))
    text = F.transform("matches", lambda m: F.concat_ws(
        ":", m["licence"], m["template"].cast("string"), m["first_word"].cast("string"), m["end_word"].cast("string"), F.round(m["dice"], 6).cast("string")))
    return found.select("doc_id", F.size("matches").cast("bigint").alias("n_licences"), F.array_join(text, ",").alias("licences"))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


# CRC-32 by its table of 256 remainders, which the first view computes.
ORACLES["op11_prefix_trie"] = """
with remainders as (select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda p, q: case when p & 1 = 1 then xor(p >> 1, 3988292384) else p >> 1 end)) as tab),
own as (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as w from conversations where conv_id is not null group by conv_id),
heads as (select conv_id, w, xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ord(c) as bigint))),
          lambda p, q: xor(p >> 8, tab[(xor(p, q) & 255) + 1])), 4294967295) % 6 as h from own, remainders),
seqs as (select o.conv_id, list_concat(list_slice(coalesce(f.w, []), 1, h), list_slice(o.w, h + 1, len(o.w))) as s
         from heads o left join own f on f.conv_id = o.conv_id - o.conv_id % 100),
ends as (select s as p, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256 from seqs group by s),
nodes as (select list_slice(s, 1, d) as p, d, min(conv_id) as conv_id, count(*) as n_convs
          from (select conv_id, s, unnest(range(0, len(s) + 1)) as d from seqs) group by all),
kids as (select list_slice(p, 1, d - 1) as p, count(*) as n_children from nodes where d > 0 group by 1),
own_figures as (select p, d, case when d = 0 then 0 else (n_convs - 1) * length(p[d].t) end as saves, case when n_children is null then 1 else 0 end as leaf
                from nodes left join kids using (p)),
below as (select list_slice(p, 1, e) as p, sum(saves) as saved, sum(leaf) as leaves
          from (select p, saves, leaf, unnest(range(0, d + 1)) as e from own_figures) group by 1)
select n.conv_id, cast(n.d as bigint) as depth, u.conv_id as parent_conv_id, n.n_convs, cast(coalesce(n_children, 0) as bigint) as n_children,
       cast(leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, coalesce(ends_sha256, sha256('')) as ends_sha256
from nodes n join below using (p) left join kids using (p) left join ends using (p) left join nodes u on n.d > 0 and u.p = list_slice(n.p, 1, n.d - 1)
"""


def run_digest(found: DataFrame) -> DataFrame:
    """What op12 reports of the result of :func:`periodic_runs.periodic_runs`."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", periodic_runs.strongest_run()).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = periodic_runs.with_repeated_tails(_table(spark, sf_dir, "documents"))
    return run_digest(periodic_runs.periodic_runs(documents))


def byte_digest(found: DataFrame) -> DataFrame:
    """What op13 reports of the result of :func:`suffix_merge.suffix_dedup`."""
    removed = F.reduce("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op13_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_digest(suffix_merge.suffix_dedup(_table(spark, sf_dir, "documents")))


# Bytes as pairs of hexadecimal digits; windows of one document that overlap or touch form a span.
ORACLES["op13_suffix_merge"] = """
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
win as (select r, doc_id, i, substr(x, 2 * i + 1, 100) as g from (select r, doc_id, x, unnest(range(0, len(x) // 2 - 49)) as i from d where len(x) >= 100)),
least as (select g, min(doc_id) as ref from win group by g having count(*) > 1),
hit as (select r, i, case when i - lag(i) over (partition by r order by i) <= 50 then 0 else 1 end as opens
        from win join least using (g) where doc_id > ref or (doc_id is null and ref is not null)),
spans as (select r, min(i) as a, max(i) + 50 as b from (select r, i, sum(opens) over (partition by r order by i) as s from hit) group by r, s),
pieces as (select r, a, substr(x, 2 * b0 + 1, 2 * (a - b0)) as piece from (select r, a, coalesce(lag(b) over (partition by r order by a), 0) as b0 from spans) join d using (r)),
kept as (select r, n, k, p || substr(x, 2 * e + 1) as y from (select r, sum(b - a) as n, count(*) as k, max(b) as e from spans group by r)
         join (select r, string_agg(piece, '' order by a) as p from pieces group by r) using (r) join d using (r))
select doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed, cast(coalesce(k, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(y, x))) as kept_sha256
from d left join kept using (r)
"""
