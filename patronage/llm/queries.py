"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, quality_knn, toxicity, warc
from .decontaminate import leaks
from .merkle import audited, document_leaves, manifest
from .mixing import with_copies
from .ngram_join import ngram_components
from .quality_rules import quality_verdicts
from .sharding import sharded
from .simhash import near_copies
from .staging import new_path, staged
from .substring_dedup import without_repeats
from .whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_ngram_jaccard")
def op1(spark, folder):
    return ngram_components(table(spark, folder, "documents"), n=4, percent=85)


CHAT_SQL = r"""
with rows as (
  select conv_id, case when conv_id is null then row_number() over () end as alone, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, null, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, null, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10)))::bigint as formatted_chars
from rows group by conv_id, alone"""


@query("op3_chat_format", CHAT_SQL)
def op3(spark, folder):
    trap = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit(trap).alias("text")),
        F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit(trap).alias("text")))).alias("t")).select("conv_id", "t.*")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(staged(chat.formatted(chat.canonical(rows)), "chat"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


RULES_SQL = r"""
with d as (select row_number() over () as row, doc_id, source, coalesce(text, '') as t from documents),
w as (select row, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
win as (select row, i, [w[i], w[i + 1], w[i + 2]] as k from (select row, w, unnest(range(1, len(w) - 1)) as i from w)),
hit as (select row, i from (select row, i, count(*) over (partition by row, k) as n from win) where n > 1),
rep as (select row, count(distinct i + o) as n_repeat_words from hit, (values (0), (1), (2)) as v(o) group by row),
c as (select doc_id, source, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
  (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines
  from d join w using (row) left join rep using (row)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, n_words < 50 as too_short, 100 * n_repeat_words > 50 * n_words as too_repetitive,
  100 * n_symbols > 10 * word_chars as too_many_symbols, 100 * n_dup_lines > 30 * n_lines as too_many_dup_lines from c),
r as (select source, unnest([1, 2, 3, 4, 5]) as rule, unnest([base_failed, too_short, too_repetitive, too_many_symbols, too_many_dup_lines]) as broken from b),
h as (select source, rule, count(*) as n, count(*) filter (broken) as f from r group by source, rule),
p as (select rule, avg(f / n) as m, var_pop(f / n) as v from h group by rule),
q as (select rule, m, case when v > 0 then least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) else 1e6 end as k from p),
g as (select source, bool_and((f + m * k) / (n + k) <= 0.5) as ok from h join q using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, too_short, too_repetitive, too_many_symbols, too_many_dup_lines,
  not base_failed and ok as kept
from b join g on b.source is not distinct from g.source"""


@query("op6_quality_rules", RULES_SQL)
def op6(spark, folder):
    return quality_verdicts(table(spark, folder, "documents")).drop("host")


MIX_SQL = r"""
with d as (select doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size, 3.0::double * sum(size) as cap,
  1 + (row_number() over (order by source nulls last) - 1) % 3 as weight from d group by source),
f as (select *, cap / weight as ratio, (select sum(source_size) from s)::double as a, (select sum(weight) from s)::double as w,
  coalesce(sum(cap) over r, 0) as cb, coalesce(sum(weight) over r, 0)::double as wb from s
  window r as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select min_by((a - cb) / (w - wb), ratio) as level from f where (a - cb) / (w - wb) <= ratio),
t as (select source, source_size, least(cap, level * weight) as target,
  case when source_size > 0 then least(cap, level * weight) / source_size else 0 end as rate from s, l),
c as (select d.*, source_size, target, rate, ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'text ' || md5(text), '')), 1, 13))::bigint
  / 4503599627370496.0::double as coin from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, (size * (floor(rate) + (coin < rate - floor(rate))::int))::bigint as taken from c"""


@query("op8_mix_sources", MIX_SQL)
def op8(spark, folder):
    out = with_copies(table(spark, folder, "documents"))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                      F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


SHARD_SQL = r"""
with tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
b as (select row_number() over () as row, doc_id, coalesce(doc_id::varchar, '') as key, coalesce(text, '') as text from documents),
c as (select row, doc_id, key, strlen(text) + 1 as size,
  case when text = '' then 0 else xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) end as text_crc32 from b, tab),
s as (select c.*, n, 1.0 / -ln((('0x' || substr(md5(key || ':' || n), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double) as bid
  from c, range(17) as r(n)),
w as (select row, doc_id, size, text_crc32, arg_max(n, bid) filter (n < 16) as shard, arg_max(n, bid) as grown_shard,
  ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '/' || text_crc32), 1, 3))::int as bucket from s group by all)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard::int as shard,
  row_number() over (partition by shard order by bucket, doc_id nulls first, text_crc32, size) - 1 as slot, grown_shard::int as grown_shard from w"""


@query("op10_shard_rendezvous", SHARD_SQL)
def op10(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharded(docs, [1.0] * 16).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


WARC_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages),
f as (select d, max(page_id) as first from p where n >= 1000 group by d)
select page_id, n::bigint as payload_bytes, p.d as payload_digest,
  case when first is null or first is not distinct from page_id then 'response' else 'revisit' end as record_type,
  case when first is not distinct from page_id then null else first end as refers_to
from p left join f on p.d = f.d and n >= 1000"""


@query("op4_warc_normalise", WARC_SQL)
def op4(spark, folder):
    whole, parts = new_path(spark, "warc-whole"), new_path(spark, "warc")
    warc.write_monolithic(warc.page_records(table(spark, folder, "pages")), whole)
    index = staged(warc.normalise(warc.archive_files(spark, whole), parts), "warc-index")
    back = warc.read_records(index)
    # of a response the length and digest are those of the bytes that were read
    read = F.col("warc_type") == "response"
    return back.select(
        F.nullif("record_id", F.lit("")).cast("long").alias("page_id"),  # a null id is an empty record id
        F.when(read, F.octet_length("body")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(read, F.sha1("body")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


def toxic_model(spark: SparkSession, folder: str, docs: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, folder, "labels"), ~toxicity.held_out(F.col("doc_id"), 5, 0))


@query("op2_toxicity")
def op2(spark, folder):
    docs = table(spark, folder, "documents")
    out = toxicity.scored(docs, toxic_model(spark, folder, docs))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


@query("op5_quality_knn")
def op5(spark, folder):
    docs = table(spark, folder, "documents")
    out_of = toxicity.held_out(F.col("doc_id"), 4, 2)
    model = quality_knn.fit(docs, table(spark, folder, "labels"), ~out_of)
    return quality_knn.scored(docs, model).select("doc_id", out_of.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op7_decontaminate")
def op7(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_substring_dedup")
def op9(spark, folder):
    return without_repeats(table(spark, folder, "documents")).drop("kept")


def merkle_field(column: str) -> str:
    return f"case when {column} is null then '-' else strlen({column}::varchar) || ':' || {column}::varchar end"


def merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = f"""
with recursive tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
crc as (select id, xor(4294967295, list_reduce(
  list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(id::varchar)), '..'), lambda x: ('0x' || x)::bigint)),
  lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) as c from (select distinct doc_id as id from documents), tab),
l as (select row_number() over () as row, doc_id, source, {merkle_leaf("text")} as leaf,
  case when c % 2 = 0 then {merkle_leaf("replace(text, chr(10), '')")} else {merkle_leaf("text")} end as changed
  from documents d left join crc on doc_id = id),
p as (select *, dense_rank() over (order by source nulls first) - 1 as tree, count(*) over (partition by source) as n,
  row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p from l),
up(tree, lv, p, n, digest) as (select tree, 0::bigint, p, n, leaf from p
  union all select tree, lv + 1, p // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by p)) from up where n > 1 group by tree, lv, p // 3),
sub as (select tree, digest as subroot from up where n = 1),
top(lv, p, n, digest) as (select 0::bigint, tree, count(*) over (), subroot from sub
  union all select lv + 1, p // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by p)) from top where n > 1 group by lv, p // 3),
node as (select tree, lv, p, n, digest from up union all select -1, lv, p, n, digest from top),
sib as (select a.tree, a.lv, a.p, coalesce(string_agg(b.digest, '' order by b.p) filter (b.p < a.p), '') as l,
  coalesce(string_agg(b.digest, '' order by b.p) filter (b.p > a.p), '') as r
  from node a join node b on a.tree = b.tree and a.lv = b.lv and a.p // 3 = b.p // 3 where a.n > 1 group by all),
low(row, tree, lv, p, digest, proof) as (select row, tree, 0::bigint, p, changed, '' from p
  union all select row, w.tree, w.lv + 1, w.p // 3, sha256(l || digest || r), proof || l || r from low w join sib s on w.tree = s.tree and w.lv = s.lv and w.p = s.p),
high(row, lv, p, digest, proof) as (select row, 0::bigint, tree, arg_max(digest, lv), arg_max(proof, lv) from low group by row, tree
  union all select row, w.lv + 1, w.p // 3, sha256(l || digest || r), proof || l || r from high w join sib s on s.tree = -1 and w.lv = s.lv and w.p = s.p),
done as (select row, arg_max(digest, lv) as folded_root, sha256(arg_max(proof, lv)) as proof_sha256 from high group by row),
r as (select digest as root from top where n = 1)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from p join sub using (tree) join done using (row), r"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark, folder):
    leaves = document_leaves(table(spark, folder, "documents"))
    return audited(manifest(leaves)).withColumnRenamed("id", "doc_id")


@query("op12_simhash_balls")
def op12(spark, folder):
    return near_copies(table(spark, folder, "documents"))


@query("op13_whitening")
def op13(spark, folder):
    return whitened(table(spark, folder, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as long)"))
