"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.llm import alignment, filteraudit, licenses, mixing, packing, permindex, pitmanyor, quality, secretscan, simhash, tokenfiles, toxicity, warcshards
from shoplane.llm.common import remainder, table
from shoplane.session import scratch_path

VOCABULARY = "word_bpe_49k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, distance=4)
    return found.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permindex.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels, remainder("doc_id", 4) != 2)
    scored = documents.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), toxicity.scores(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(1.0, 2.0, 3.0), share=1.0, most=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), tokenizer_path(), folder, end_id=2)
    return tokenfiles.read(spark, folder)


def op7_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secretscan.scan(documents, secretscan.fit(documents))


def op8_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = pitmanyor.fit(documents.filter(remainder("doc_id", 7) != 2))
    scored = pitmanyor.score(documents, model)
    held_out = (remainder("doc_id", 7) == 2).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warcshards.write(table(spark, sf_dir, "pages"), folder)
    return warcshards.read(spark, folder)


def op12_pointer_jump_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _level_sql() -> str:
    """The rules' cutoffs as SQL values: level, rule, cutoff."""
    return ", ".join(f"({level}, '{name}', {value})" for name, (_, values) in quality.RULES.items() for level, value in enumerate(values, 1))


QUALITY_SQL = f"""
with raw as (
  select row_number() over () as rid, doc_id, lang as stratum, coalesce(text, '') as t from documents
), words as (
  select rid, doc_id, stratum, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from raw
), starts as (select rid, w, unnest(generate_series(1, len(w) - 7)) as i from words where len(w) >= 8
), windows as (select rid, i, list_slice(w, i, i + 7) as g from starts
), twice as (select rid, i from windows qualify count(*) over (partition by rid, g) > 1
), covered as (select rid, count(distinct i + o) as n from twice, range(8) s(o) group by rid
), counts as (
  select words.rid, doc_id, stratum, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
    len(l) as n_lines, length(regexp_replace(t, '[^!]', '', 'g')) as n_shouts
  from words left join covered on words.rid = covered.rid
), judged as (
  select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
    cast(n_symbols as double) / greatest(word_chars, 1) as symbol_share, cast(n_repeat_words as double) / greatest(n_words, 1) as repeat_share,
    cast(n_dup_lines as double) / greatest(n_lines, 1) as dup_line_share, cast(n_shouts as double) / greatest(n_words, 1) as shout_share,
    cast(word_chars as double) / greatest(n_words, 1) as word_length from counts
), features as (
  select rid, stratum, base_failed, doc_id, unnest(['symbol_share', 'repeat_share', 'dup_line_share', 'shout_share', 'word_length']) as rule,
    unnest([symbol_share, repeat_share, dup_line_share, shout_share, word_length]) as x from judged
), marks as (
  select doc_id, max(quality) = 1 as good from labels where quality is not null and doc_id is not null group by doc_id having min(quality) = max(quality)
), levels(level, rule, cut) as (values {_level_sql()}
), held as (select f.*, good from features f join marks using (doc_id) where not base_failed
), per_text as (
  select rid, stratum, level, bool_or(x > cut) as over from held join levels on held.rule = levels.rule where good group by all
), strata as (select stratum, count(distinct rid) filter (where good) as n from held group by all
), tests as (
  select strata.stratum, n, l.level, count(*) filter (where over) as k
  from strata cross join (select distinct level from levels) l
    left join per_text p on p.level = l.level and p.stratum is not distinct from strata.stratum group by all
), counted as (select stratum, n, level, k from tests union all select '(all)', sum(n), level, sum(k) from tests group by level
), each as (select {quality.DOUBT} / (count(*) + 1) as d from strata
), judged_levels as (
  select stratum, n, level, n > 0 and k < n * {quality.RISK} and (select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
    + j * ln({quality.RISK}) + (n - j) * ln(1 - {quality.RISK}))) from unnest(generate_series(0, cast(k as int))) s(j)) <= d as safe from counted, each
), last as (
  select stratum, any_value(n) as n, coalesce(min(level) filter (where not safe) - 1, max(level)) as level from judged_levels group by stratum
), chosen as (
  select stratum, case when n * ln(1 - {quality.RISK}) > ln(d) then (select level from last where stratum = '(all)') else level end as level
  from last, each where stratum is distinct from '(all)'
), rejected as (
  select distinct f.rid from features f join chosen s on f.stratum is not distinct from s.stratum join levels l on l.level = s.level and l.rule = f.rule and f.x > l.cut
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rid not in (select rid from rejected) as kept
from judged
"""


#: Five hex digits of the digest are twenty bits, four letters of base 32.
WARC_SQL = """
with payloads as (
  select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages
), firsts as (
  select t, min(page_id) as first from payloads group by t
), digits as (
  select payloads.page_id, t, first, list_transform(generate_series(0, 7), lambda i: cast('0x' || substr(h, cast(i * 5 + 1 as int), 5) as bigint)) as v
  from payloads join firsts using (t)
)
select page_id, cast(strlen(t) as bigint) as payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((x >> s) & 31) + 1 as int), 1)), '')), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from digits
"""

AUDIT_SQL = """
with raw as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, min(doc_id) over (partition by coalesce(text, '')) as first from documents
), words as (
  select *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from raw
), marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id
), failing as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(first < words.doc_id, false)} as f
  from words left join marks on words.doc_id = marks.doc_id
), kinds as (
  select part, good, toxic, (case when f.A then 'A' else '' end) || (case when f.B then 'B' else '' end) || (case when f.C then 'C' else '' end)
    || (case when f.D then 'D' else '' end) || (case when f.E then 'E' else '' end) as fails, count(*) as n
  from failing group by all
), letters(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')
), orders as (
  select a.x || b.x || c.x || d.x || e.x as o from letters a, letters b, letters c, letters d, letters e
  where b.x <> a.x and c.x not in (a.x, b.x) and d.x not in (a.x, b.x, c.x) and e.x not in (a.x, b.x, c.x, d.x)
), steps as (select o, cast(s as int) as step, substr(o, cast(s as int), 1) as x from orders, generate_series(1, 5) g(s)
), gone as (
  select kinds.*, o, coalesce((select min(strpos(o, z.x)) from letters z where strpos(fails, z.x) > 0), 9) as removed_at from kinds, orders
), cells as (
  select part, steps.o, step, steps.x,
    sum(case when removed_at > step then n else 0 end) as kept, sum(case when removed_at = step then n else 0 end) as removed,
    sum(case when strpos(fails, steps.x) > 0 and removed_at < step then n else 0 end) as redundant,
    sum(case when fails = steps.x then n else 0 end) as unique_fails,
    sum(case when removed_at = step and good = 1 then n else 0 end) as good_lost,
    sum(case when removed_at = step and toxic = 1 then n else 0 end) as toxic_lost
  from gone join steps on gone.o = steps.o group by all
)
select part, o as filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, x) as bigint) as shapley
from cells
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        made.__name__: made
        for made in (
            op1_best_fit_packing,
            op2_simhash_near_dedup,
            op3_permutation_index,
            op4_toxicity,
            op5_cube_mixing,
            op6_rans_token_files,
            op7_markov_secret_scan,
            op8_license_signatures,
            op9_risk_controlled_quality,
            op10_pitman_yor_scores,
            op11_sharded_warc,
            op12_pointer_jump_alignment,
            op13_filter_audit,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_risk_controlled_quality": QUALITY_SQL, "op11_sharded_warc": WARC_SQL, "op13_filter_audit": AUDIT_SQL}
