"""The queries registered for this subpackage: op1 to op13, each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, imatch, licenses, orchard, parity, prefixes, quality, simhash, tokens, toxicity, urls
from ._common import cut, text_rows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold markers; each is a reply tree with a single branch."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.sql(
        "select * from values (bigint(-1), bigint(0), 'user', '</s>[INST] ok [/INST]'), "
        "(bigint(-1), bigint(1), 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"
    )
    chats = chat.format_chats(chat.linear_messages(turns.unionByName(marked)))
    return chat.digest(chats).select(
        F.col("tree_id").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    counted = tokens.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).drop("text")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    weights = quality.fit(docs, _table(spark, sf_dir, "labels"), lambda c: ~quality.held_out(c))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice: doc_id, template, coverage, start and stop (code points), matched words."""
    return licenses.matches(text_rows(_table(spark, sf_dir, "documents")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    scanned = decontam.scan(docs, _table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    weights = toxicity.fit(docs, _table(spark, sf_dir, "labels"), lambda c: ~toxicity.held_out(c))
    scored = toxicity.score(docs, weights)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_rows(_table(spark, sf_dir, "documents"))
    words = cut(imatch.lexicon(docs))
    return imatch.compare_edited(docs, words)


def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 centroids, three rounds."""
    return orchard.cluster(_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return prefixes.trie(prefixes.with_shared_heads(turns))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.jaccard_groups(_table(spark, sf_dir, "documents"))


_QUERIES = (
    op1_chat_format,
    op2_token_counts,
    op3_byte_bpe,
    op4_simhash,
    op5_url_filter,
    op6_quality,
    op7_license_scan,
    op8_decontaminate,
    op9_toxicity,
    op10_imatch,
    op11_orchard,
    op12_prefix_trie,
    op13_jaccard_join,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_SQL, "op8_decontaminate": OP8_SQL, "op11_orchard": _op11_sql(), "op12_prefix_trie": OP12_SQL}


OP1_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(regexp_replace(text, '([\[<])(\\*)(/?(?:INST|SYS|OUT|TURN|s>))', '\1\\\2\3', 'g'))
       + case role when 'user' then 13 when 'system' then 11 when 'assistant' then 11 else 14 + length(url_encode(role)) end
       as size from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role) filter (role = 'assistant'), '')) as loss_sha256,
       cast(7 + sum(size) as bigint) as formatted_chars
from sized group by conv_id
"""

OP8_SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as win
  from item_words, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as t(k) where len(w) > 0),
lengths as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as win
  from doc_words, lengths, unnest(range(1, len(w) - n + 2)) as t(k) where len(w) >= n),
hits as (select d.doc_id, d.n, d.k, i.item_id from doc_windows d join item_windows i using (n, win)),
hit_words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(k, k + n)) as t(p) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


def _op11_sql(k: int = 16, rounds: int = 3, size: int = 64) -> str:
    """Rounds written out: distances of all vectors to all centroids, least (distance, number) first."""
    parts = [
        f"""kept as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size})""",
        f"""c0 as (
  select row_number() over (order by sha256('1:' || vec_id), v) - 1 as c, v from kept
  order by sha256('1:' || vec_id), v limit {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} as (
  select vec_id, v, min((d, c)) as best from (
    select kept.vec_id, kept.v, cast(c as int) as c,
      cast(list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d
    from kept, c{r}) group by vec_id, v)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} as (
  select c{r}.c, coalesce(moved.v, c{r}.v) as v from c{r} left join (
    select c, list((s - ((s % n) + n) % n) // n order by i) as v from (
      select best[2] as c, i, sum(v[i]) as s, count(*) as n from a{r}, range(1, {size + 1}) as t(i) group by 1, 2)
    group by c) as moved using (c))"""
            )
    return "with " + ",\n".join(parts) + f"""
select vec_id, best[2] as cluster, best[1] as distance, cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia,
  cast(sum(best[1]) over () as bigint) as inertia, sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from a{rounds} join c{rounds} on c{rounds}.c = best[2]
"""


OP12_SQL = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
convs as (
  select conv_id, xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: case when b >= 0 then xor(a, b) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)) % 4 as h
  from (select distinct conv_id from t)),
built as (
  select c.conv_id, 0 as part, pos, role, text from convs c join t on t.conv_id = c.conv_id - c.conv_id % 20 where pos <= h
  union all select c.conv_id, 1, pos, role, text from convs c join t on t.conv_id = c.conv_id where pos > h),
seq as (
  select conv_id, coalesce(list(length(role) || ':' || role || text order by part, pos) filter (role is not null), []) as l,
    coalesce(list(len(regexp_extract_all(text, '[^ 	-]+')) order by part, pos) filter (role is not null), []) as w
  from convs left join built using (conv_id) group by conv_id),
node as (
  select d, l[1:d] as k, min(conv_id) as conv_id, count(*) as n_convs, any_value(case d when 0 then 0 else w[d] end) as words,
    list(conv_id order by conv_id) filter (len(l) = d) as ends
  from seq, unnest(range(0, len(l) + 1)) as u(d) group by 1, 2),
children as (select d - 1 as d, k[1:d - 1] as k, count(*) as n from node where d > 0 group by 1, 2),
below as (
  select u.d, node.k[1:u.d] as k, count(*) filter (children.n is null) as n_leaves, sum((n_convs - 1) * words) as saved
  from node left join children on children.d = node.d and children.k = node.k, unnest(range(0, node.d + 1)) as u(d) group by 1, 2)
select node.conv_id, node.d as depth, up.conv_id as parent_conv_id, node.n_convs, coalesce(children.n, 0) as n_children,
  n_leaves, cast(saved as bigint) as saved_tokens, sha256(coalesce(array_to_string(node.ends, ','), '')) as ends_sha256
from node join below on below.d = node.d and below.k = node.k
left join children on children.d = node.d and children.k = node.k
left join node up on node.d > 0 and up.d = node.d - 1 and up.k = node.k[1:node.d - 1]
"""
