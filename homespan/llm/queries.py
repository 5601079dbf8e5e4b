"""Registered queries of the operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from homespan.llm import (
    collocations, decontaminate, pii, preferences, quality, simhash, spelling, suffix_dedup, token_counts, token_store, toxicity, trie_bpe,
    url_filter)
from homespan.session import fresh_path

VOCABULARY = "byte_bpe_50k.json"
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "quality")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    quality.measured(docs).drop("text").write.parquet(path)
    rows = spark.read.parquet(path)
    judged = quality.judged(rows, quality.thresholds(quality.sketches(rows)))
    return judged.select("doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
                         "_verdict.base_failed", "_verdict.kept")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_store.write_store(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_store.read_store(spark, path)


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.start, s.end)), ",")
    return preferences.preference_records(preferences.reply_pairs(_table(spark, sf_dir, "conversations"))).withColumns(
        {"chosen_mask": spans("chosen_mask"), "rejected_mask": spans("rejected_mask")})


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", trie_bpe.digests(F.col("text"), tokenizer_path()).alias("d")).select("doc_id", "d.*")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, *toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", pii.spans_column(docs, pii.fit(docs)).alias("p")).select("doc_id", "p.*")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path(), limit=1024).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("lang", "text")
    found = collocations.collocations(spark, docs, threshold=30, max_words=4, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spark, docs).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_token_store, op3_preferences, op4_decontamination, op5_simhash, op6_bpe, op7_suffix_dedup,
    op8_url_filter, op9_toxicity, op10_pii, op11_token_counts, op12_collocations,
    op13_spelling)}

ORACLE = {
    "op3_preferences": """
with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null and turn is not null),
ends as (select conv_id, max(turn) as last, max_by(text, turn) as reply from turns where role = 'assistant' group by 1),
pairs as (select a.conv_id as pair_id, a.last, b.reply as other from ends a join ends b on b.conv_id = a.conv_id + 1),
kept as (select p.pair_id, r.turn, r.role, r.text, p.other, r.turn = p.last as is_last,
    row_number() over (partition by p.pair_id order by r.turn) as n
  from pairs p join turns r on r.conv_id = p.pair_id and r.turn <= p.last),
sides as (select *, 'chosen' as side, text as said from kept
  union all select *, 'rejected', case when is_last then other else text end from kept),
cut as (select pair_id, coalesce(min(n) filter (where is_last and other <> text) - 1, max(n)) as k, max(n) as total
  from kept group by 1),
piece as (select b.pair_id, b.side, b.n, b.role, '<|im_start|>' || b.role || chr(10) as head, b.said || '<|im_end|>' as body,
    b.n > c.k as is_after from sides b join cut c using (pair_id)),
placed as (select *, sum(length(head) + length(body) + 1) over (partition by pair_id, side, is_after order by n)
    - length(body) - 1 as s from piece),
texts as (select pair_id, side,
    coalesce(string_agg(head || body || chr(10), '' order by n) filter (where not is_after), '') as before,
    coalesce(string_agg(head || body || chr(10), '' order by n) filter (where is_after), '') as after,
    coalesce(string_agg(s || ':' || (s + length(body)), ',' order by n) filter (where is_after and role = 'assistant'), '') as mask
  from placed group by 1, 2)
select c.pair_id, g.before as prompt, g.after as chosen, b.after as rejected, g.mask as chosen_mask, b.mask as rejected_mask,
  c.k as n_shared_turns, c.total as n_chosen_turns, c.total as n_rejected_turns
from cut c join texts g on g.pair_id = c.pair_id and g.side = 'chosen'
join texts b on b.pair_id = c.pair_id and b.side = 'rejected'""",
    "op8_url_filter": r"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from u),
rules(verdict, rule_host, rule_path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits as (select p.page_id, p.host, p.path, r.verdict, r.rule_host || r.rule_path as rule,
    row_number() over (partition by p.page_id order by length(r.rule_host) + length(r.rule_path) desc) as n
  from parts p left join rules r on starts_with(p.path, r.rule_path)
    and (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)))
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(verdict, 'allow') as verdict
from fits where n = 1""",
    "op12_collocations": r"""
with d as (select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') as ws from p),
ks(k) as (values (1), (2), (3), (4)),
g as (select lang, k, unnest(range(1, len(ws) - k + 2)) as i, ws from w join ks on len(ws) >= k),
f as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase, count(*) as cnt from g group by all),
n as (select lang, sum(len(ws))::bigint as n from w group by 1),
cand as (select lang, k, phrase, cnt as a, string_split(phrase, ' ') as ws from f where k >= 2 and cnt >= 30),
cuts as (select c.lang, c.phrase, c.a, j, array_to_string(c.ws[1:j], ' ') as lp, array_to_string(c.ws[j + 1:], ' ') as rp
  from (select *, unnest(range(1, k)) as j from cand) c),
scored as (select c.lang, c.phrase, c.a, c.j, fl.cnt as l, fr.cnt as r,
    ((2000000::hugeint * c.a) // (fl.cnt + fr.cnt))::bigint as score
  from cuts c join f fl on fl.lang = c.lang and fl.phrase = c.lp join f fr on fr.lang = c.lang and fr.phrase = c.rp),
best as (select lang, phrase, a, arg_min(l, score * 10 + j) as l, arg_min(r, score * 10 + j) as r, min(score) as score
  from scored group by 1, 2, 3),
inner_parts as (select c.lang, array_to_string(c.ws[i:i + m - 1], ' ') as phrase, c.a as outer_a
  from (select *, unnest(range(2, k)) as m from cand where k >= 3) c, lateral (select unnest(range(1, c.k - c.m + 2)) as i)),
covered as (select lang, phrase, max(outer_a) as outer_a from inner_parts group by 1, 2),
kept as (select b.* from best b left join covered v on v.lang = b.lang and v.phrase = b.phrase
  where v.outer_a is null or v.outer_a * 100 < b.a * 80),
ranked as (select k.lang, row_number() over (partition by k.lang order by k.score desc, k.a desc, k.phrase asc) as rank,
    k.phrase, k.a, k.l, k.r, n.n, k.score from kept k join n using (lang))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score from ranked where rank <= 2000""",
}
